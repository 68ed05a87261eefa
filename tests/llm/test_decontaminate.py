import math
import random
import re
from collections import Counter

from helpers import edge_docs, empty_docs

from ledgerline.llm import decontaminate as D

ITEMS = [(1, "What is the capital city of the old northern kingdom by the lake? It is Brontovaria."),
         (2, "Name the metal that melts in a warm hand and was found in Paris. Gallium."),
         (3, "Name the metal that melts in a warm hand and was found in Paris. Gallium."), (4, None), (5, ""), (6, "..."),
         (7, " ".join(f"longitem{i} word{i % 7}" for i in range(90)) + ". The end of it.")]


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def filler(rnd, n):
    return " ".join(rnd.choice(["the", "of", "lake", "hand", "metal", "in", "and", "quiet", "stone", "river", "was", "it", "is"]) for _ in range(n))


def test_planted_items_are_found_and_clean_texts_left(spark):
    rnd = random.Random(1)
    docs, want = [], set()
    for i in range(60):
        t = filler(rnd, rnd.choice([0, 3, 120, 300]))
        if i % 3 == 0:
            k, item = ITEMS[rnd.choice([0, 1, 6])]
            t += " " + (item.upper() if i % 2 else item) + " " + filler(rnd, rnd.choice([0, 100]))
            want |= {(i, k)} | ({(i, 3)} if k == 2 else set())
        docs.append((i, t))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "'x' as item_id", "1 as score")
    got = D.contaminated_pairs(df, items(spark)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert all(r.question_overlap == 1.0 and r.score >= D.THRESHOLD for r in got)
    clean = D.decontaminate(df, items(spark))
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == set(range(60)) - {i for i, _ in want}


def test_changed_words_and_parts_of_items(spark):
    q = ITEMS[0][1]
    docs = [(1, q.replace("northern", "southern")), (2, "What is the capital city of the moon? Nobody knows it at all."), (3, q.split("?")[0]),
            (4, q.split("?")[1])]
    got = D.contaminated_pairs(spark.createDataFrame(docs, "doc_id bigint, text string"), items(spark)).collect()
    assert {r.doc_id for r in got} == {1, 3}


def test_retrieval_equals_brute_force():
    rnd = random.Random(5)
    index = D.Index([(k, filler(rnd, rnd.randint(1, 90))) for k in range(40)] + ITEMS)
    texts = [filler(rnd, rnd.choice([0, 5, 127, 128, 129, 400])) + " " + rnd.choice(ITEMS)[1].__str__() for _ in range(40)]
    docs = index.terms_of(texts)
    for d, t in zip(docs, texts):
        assert d.tolist() == [index.terms.get(w, -1) for w in D.words_of(t)]
    for threshold in (0.3, 0.6, 0.9):
        want = {}
        for k, d in enumerate(docs):
            for p in range(max(1, -(-len(d) // D.STEP))):
                terms = set(d[p * D.STEP:p * D.STEP + D.STEP + D.PART].tolist())
                for q, w in enumerate(index.weights):
                    score = sum(x for t, x in w.items() if t in terms)
                    if score >= threshold - 1e-9:
                        want[k, p, q] = round(score, 9)
        assert {(k, p, q): round(s, 9) for k, p, q, s in D.retrieve(index, docs, threshold)} == want


def test_several_indexes_give_the_same_pairs(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = {(r.doc_id, r.item_id) for r in D.contaminated_pairs(docs, bench).collect()}
    scores = {(r.doc_id, r.item_id): round(r.score, 9) for r in D.contaminated_pairs(docs, bench).collect()}
    monkeypatch.setattr(D, "INDEX_ITEMS", 15)
    assert {(r.doc_id, r.item_id) for r in D.contaminated_pairs(docs, bench).collect()} == one and one
    # with the statistics of all items, scores are the same too
    assert {(r.doc_id, r.item_id): round(r.score, 9) for r in D.contaminated_pairs(docs, bench).collect()} == scores


def test_edge_rows_and_empty_tables(spark):
    docs = edge_docs(spark, clash=["item_id", "score"])
    assert D.contaminated_pairs(docs, items(spark)).count() == 0
    assert D.decontaminate(docs, items(spark)).count() == docs.count()
    assert D.contaminated_pairs(empty_docs(spark), items(spark)).count() == 0
    assert D.decontaminate(docs, items(spark).limit(0)).count() == docs.count()
    assert D.contaminated_pairs(docs, items(spark).limit(0)).count() == 0


def brute(docs, rows):
    """Pairs by the definition: every passage against every part, then the overlaps."""
    items = [(i, D.words_of(t), t) for i, t in rows if D.words_of(t)]
    parts = []
    for i, words, text in items:
        starts = [0] if len(words) <= D.PART else [*range(0, len(words) - D.PART, D.PART_STEP), len(words) - D.PART]
        parts += [(i, words, text, words[a:a + D.PART]) for a in starts]
    df = Counter(t for p in parts for t in set(p[3]))
    mean = sum(len(p[3]) for p in parts) / len(parts)

    def ratio(part, words):
        n = min(D.GRAM, len(part))
        own = {tuple(part[k:k + n]) for k in range(len(part) - n + 1)} if n else set()
        return len(own & {tuple(words[k:k + n]) for k in range(len(words) - n + 1)}) / len(own) if own else 1.0

    out = set()
    for d, text in docs:
        words = D.words_of(text)
        for at in range(0, max(1, len(words)), D.STEP):
            passage = set(words[at:at + D.STEP + D.PART])
            for i, whole, item, part in parts:
                w = {t: math.log1p((len(parts) - df[t] + 0.5) / (df[t] + 0.5)) * n * (D.K1 + 1)
                     / (n + D.K1 * (1 - D.B + D.B * len(part) / mean)) for t, n in Counter(part).items()}
                if sum(x for t, x in w.items() if t in passage) / sum(w.values()) < D.THRESHOLD - 1e-9:
                    continue
                near = words[max(0, at - len(whole)):at + D.STEP + D.PART + len(whole)]
                sentences = [x for x in re.split(r"(?<=[.!?])\s+", item) if D.words_of(x)]
                answer = D.words_of(sentences[-1]) if len(sentences) > 1 else []
                q, a = ratio(whole[:len(whole) - len(answer)], near), ratio(answer, near)
                if q >= 0.6 and (a >= 0.5 or q >= 0.8) or ratio(whole, near) >= 0.6 or ratio(part, near) >= 0.6:
                    out.add((d, i))
    return out


def test_pairs_against_brute_force(spark):
    rnd = random.Random(8)
    rows = [(k, filler(rnd, rnd.randint(1, 40)) + rnd.choice([".", "? "]) + filler(rnd, rnd.randint(0, 30)) + f" key{k} word{k}.") for k in range(25)] + ITEMS
    rows.append((100, " ".join(f"t{k % 150}x{k}" for k in range(200))))
    docs = []
    for k in range(80):
        words = D.words_of(rnd.choice(rows)[1])
        cut = words[rnd.choice([0, 0, rnd.randrange(len(words) + 1)]):][:rnd.choice([5, 30, 64, 200, 200])]
        docs.append((k, filler(rnd, rnd.choice([0, 20, 140])) + " " + " ".join(w if rnd.random() < 0.95 else "other" for w in cut) + " " + filler(rnd, 30)))
    got = D.contaminated_pairs(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(rows, "item_id bigint, text string"))
    got = [(r.doc_id, r.item_id) for r in got.collect()]
    assert set(got) == brute(docs, rows) and len(got) == len(set(got)) > 20


def test_copied_parts_and_long_answers(spark):
    long = " ".join(f"part{k}" for k in range(200))
    answer = "Well. " + " ".join(f"answer{k}" for k in range(24)) + "."
    bench = spark.createDataFrame([(1, long), (2, answer)], "item_id bigint, text string")
    words = long.split()
    docs = [(a, "the house " * 40 + " ".join(words[a:a + 64]) + " of the lake" * 30) for a in range(0, 137, 3)]
    docs += [(1000, " ".join(f"answer{k}" for k in range(24))), (1001, " ".join(words[:12]) + " and no more"), (1002, "answer1 answer2 answer3")]
    got = {(r.doc_id, r.item_id) for r in D.contaminated_pairs(spark.createDataFrame(docs, "doc_id bigint, text string"), bench).collect()}
    assert got == {(d, 1) for d, _ in docs[:-3]} | {(1000, 2)}

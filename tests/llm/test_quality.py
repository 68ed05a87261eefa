import re

from helpers import LONG, edge_docs, empty_docs

from ledgerline.llm import quality as Q

WORDS = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORDS.findall(t)
    win = {}
    for i in range(len(w) - 2):
        win.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {i + k for at in win.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in t.split("\n") if WORDS.search(x)]
    return (len(w), sum(map(len, w)), sum(c in Q.SYMBOLS for c in t), t.count("!"), len(lines),
            len(lines) - len(set(lines)), len(covered))


def test_measures_match_brute_force_on_edge_rows(spark):
    docs = edge_docs(spark, clash=["ledger", "q_words", "n_words"])
    got = Q.ledger(docs, out="led").select("text", "led.*").collect()
    assert len(got) == docs.count()
    for r in got:
        assert tuple(r[c] for c in Q.MEASURES) == brute(r.text)


def test_measures_on_repeats(spark):
    texts = ["a b c a b c", "a b c d\na b c d\n\na b c d", "x " * 500, "!!! $$ | a", "a  b\tc\x0bd\x0ce\rf"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    for r in Q.ledger(df).select("text", "ledger.*").collect():
        assert tuple(r[c] for c in Q.MEASURES) == brute(r.text)


def test_empty_table(spark):
    assert Q.ledger(empty_docs(spark)).count() == 0
    assert [r.n_failed for r in Q.ablation(Q.ledger(empty_docs(spark))).collect()] == [0] * len(Q.POLICIES["v2"])


def test_policies_and_ablation_use_the_stored_bits(spark):
    rows = [(1, Q.rule_mask(["symbols"])), (2, Q.rule_mask(["symbols", "few_words"])), (3, 0), (4, Q.rule_mask(["few_words"]))]
    df = spark.createDataFrame(rows, "doc_id bigint, failed_bits bigint")
    assert {r.doc_id for r in df.where(Q.passes(df.failed_bits, "v1")).collect()} == {1, 3}
    assert {r.doc_id for r in df.where(Q.passes(df.failed_bits, "v2")).collect()} == {3}
    ab = {r.rule: (r.n_failed, r.n_only) for r in Q.ablation(df, "v2", "failed_bits").collect()}
    assert ab["symbols"] == (2, 1) and ab["few_words"] == (2, 1) and ab["long_words"] == (0, 0)


def test_stored_ledger_gives_policies_and_ablation(spark, scratch):
    """Bits written once and read again; brute force from the texts, under both policies."""
    texts = ["x " * 60, "a b", "!! " * 80, "# $ % & word " * 30, " ".join(f"w{i}" for i in range(90)), None,
             " ".join(f"extraordinarily{i}long" for i in range(70)), "one two\n" * 40 + " ".join(f"v{i}" for i in range(400)),
             "\n".join(["same line here"] * 9 + [f"q{i}" for i in range(3)]), " ".join(chr(97 + i % 26) + str(i % 9) for i in range(300))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    Q.ledger(df).select("doc_id", "ledger").write.parquet(scratch + "/ledger")
    led = spark.read.parquet(scratch + "/ledger")

    def failed(text):
        n, chars, symbols, marks, lines, dup, rep = brute(text)
        return {name for name, bad in zip([name for name, _ in Q.RULES], (
            n < 50, 100 * rep > 50 * n, chars < 3 * n, chars > 12 * n, 100 * symbols > 30 * n, 100 * marks > 50 * n,
            lines >= 4 and 100 * dup > 50 * lines)) if bad}

    for policy, rules in Q.POLICIES.items():
        want = [failed(t) & set(rules) for t in texts]
        bits = led.ledger.failed_bits
        got = led.select("doc_id", Q.passes(bits, policy).alias("kept"), Q.only_rule(bits, policy).alias("only")).collect()
        assert {r.doc_id: (r.kept, r.only) for r in got} == {
            i: (not w, next(iter(w)) if len(w) == 1 else None) for i, w in enumerate(want)}
        ab = {r.rule: (r.n_failed, r.n_only) for r in Q.ablation(led, policy).collect()}
        assert ab == {r: (sum(r in w for w in want), sum(w == {r} for w in want)) for r in rules}


def test_filter_keeps_rows_and_columns(spark):
    docs = edge_docs(spark, clash=["quality_ledger"])
    kept = Q.filter_quality(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 2, 8]
    assert brute(LONG)[6] > brute(LONG)[0] / 2  # the long text repeats itself


def test_no_python_in_the_plan(spark):
    plan = Q.filter_quality(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

import hashlib
import struct

import corpus_pipeline as P
from helpers import empty_docs
from test_ngram_join import brute as groups
from test_quality import brute as measures
from test_secrets import brute as spans

from ledgerline.llm import decontaminate as D
from ledgerline.llm import quality as Q
from ledgerline.llm.common import table, word_bpe

SF = "/root/testdata/sf0.001"


def passes(text):
    m = dict(zip(Q.MEASURES, measures(text)))
    return not any((m["n_words"] < 50, 100 * m["n_repeat_words"] > 50 * m["n_words"], m["word_chars"] < 3 * m["n_words"],
                    m["word_chars"] > 12 * m["n_words"], 100 * m["n_symbols"] > 30 * m["n_words"], 100 * m["n_exclaim"] > 50 * m["n_words"],
                    m["n_lines"] >= 4 and 100 * m["n_dup_lines"] > 50 * m["n_lines"]))


def redacted(text):
    found = sorted(tuple(map(int, x.split(":")[1:])) for x in spans(text)[4].split(",") if x)
    out, at = "", 0
    for s, e in found:
        if s >= at:
            out += text[at:s] + "[SECRET]"
        at = max(at, e)
    return out + text[at:]


def test_run_matches_brute_force(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(word_bpe())
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    rows = [r for r in rows if passes(r[1])]
    keep = {d for d, _, c in groups(rows) if d == c}
    rows = [r for r in rows if r[0] in keep]
    items = [D.words_of(r.text) for r in table(spark, SF, "benchmark").collect()]
    flat = {d: " " + " ".join(D.words_of(t)) + " " for d, t in rows}
    rows = [r for r in rows if not any(" " + " ".join(i) + " " in flat[r[0]] for i in items)]
    want = {}
    for d, t in rows:
        ids = library.encode(redacted(t), add_special_tokens=False).ids
        want[d] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                   hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in P.run(spark, SF).collect()}
    assert got == want and 50 < len(got) < 200


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = empty_docs(spark).selectExpr("*", "cast(null as bigint) as n_chars", "'x' as text_hash")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0, name
    assert P.STAGES[-1][1](spark, docs, SF).count() == 0


def test_one_of_repeated_rows_stays(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(4, text, "a"), (4, text, "a"), (9, text + " more", "b"), (2, text.replace("w5 ", "x "), "c"), (7, "other words entirely here now", "d"),
            (None, text, "e"), (8, None, "f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept_id string")
    got = sorted(((r.doc_id, r.kept_id) for r in P.keep_one_of_group(spark, docs, SF).collect()))
    assert got == [(2, "c"), (7, "d"), (8, "f")]


def test_rows_without_ids_and_repeated_ids_go_by_their_own_text(spark):
    text, other = " ".join(f"w{i}" for i in range(80)), " ".join(f"v{i}" for i in range(80))
    rows = [(1, text, "kept"), (None, text, "copy"), (None, text.replace("w5 ", "x "), "near copy"),
            (None, "some quite different words that stand alone", "alone"), (None, other, "first of two"), (None, other + " more", "second of two"),
            (None, None, "null"), (None, "", "empty"), (1, other, "near copy under a kept id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, mark_a string")
    got = {r.mark_a for r in P.keep_one_of_group(spark, docs, SF).collect()}
    # the rows of the other text: that with an id stays
    assert got == {"kept", "alone", "null", "empty", "near copy under a kept id"}
    got = {r.mark_a for r in P.keep_one_of_group(spark, docs.where("doc_id is null"), SF).collect()}
    assert len(got) == 5 and len(got & {"copy", "near copy"}) == 1 and len(got & {"first of two", "second of two"}) == 1

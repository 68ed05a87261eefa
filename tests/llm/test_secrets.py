import hashlib
import math
import random
import re

from helpers import edge_docs, empty_docs

from ledgerline.llm import secrets as S

ASSIGN = re.compile(S.ASSIGN.replace("(?i:", "((?ai:").replace("api_?key)", "api_?key))"))


def brute(text):
    t = text or ""
    base = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    base.sort()
    extra = []
    for m in re.finditer(S.CANDIDATE, t):
        v = m[0]
        if re.fullmatch(S.ALLOWED, v):
            continue
        is_hex = re.fullmatch(S.HEX_CLASS, v)
        runs = []
        for i in range(len(v) - S.WINDOW + 1):
            w = v[i:i + S.WINDOW]
            bits = -sum(w.count(c) / S.WINDOW * math.log2(w.count(c) / S.WINDOW) for c in set(w))
            if bits >= (S.HEX_BITS if is_hex else S.TOKEN_BITS) - 1e-9:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + S.WINDOW
                else:
                    runs.append([i, i + S.WINDOW])
        for a, b in runs:
            x = (m.start() + a, 3 if is_hex else 4, m.start() + b, "entropy_hex" if is_hex else "entropy_token")
            if not any(y[0] <= x[0] and x[2] <= y[2] for y in base):
                extra.append(x)
    text_of = lambda q: ",".join(f"{x[3]}:{x[0]}:{x[2]}" for x in q)
    return (*(sum(x[1] == k for x in base) for k in range(3)), hashlib.sha256(text_of(base).encode()).hexdigest(),
            text_of(sorted(base + extra)))


def random_texts(n):
    rnd = random.Random(1)
    token = "abcdefABCDEF0123456789xyzXYZ+/_=-"
    pieces = [
        lambda: "".join(rnd.choices(token, k=rnd.randint(1, 70))), lambda: "".join(rnd.choices("0123456789abcdef", k=rnd.randint(15, 45))),
        lambda: "AKIA" + "".join(rnd.choices("ABCZ0123456789", k=rnd.randint(0, 22))),
        lambda: rnd.choice(["token", "Password", "api_key", "APIKEY", "secret", "passwd"]) + rnd.choice(["", "'", '"']) + " " * rnd.randint(0, 2)
        + rnd.choice(":=") + " " * rnd.randint(0, 2) + rnd.choice(["", '"']) + rnd.choice(["abc", "hunter22", "x=y=z", "token: abcdefgh"]),
        lambda: "héllo ✓ 😀", lambda: "\n", lambda: "a" * 40, lambda: "deadbeef-0000-1111-2222-333344445555"]
    return ["".join(rnd.choice(pieces)() + rnd.choice(["", " ", "\n", " é"]) for _ in range(rnd.randint(0, 12))) for _ in range(n)]


def test_spans_match_brute_force(spark):
    texts = [*random_texts(120), None, "", "token=" + "aB3+" * 2000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: tuple(r)[1:] for r in S.digest(S.scan(df)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert sum("entropy" in x[4] for x in got.values()) > 20


def test_long_hyphenated_candidates_do_not_overflow(spark):
    texts = ["ab-" * 100_000, "Ab-12_" * 50_000, "path/" * 60_000, "ab-" * 100_000 + "aB", "x token=hunter22 " + "a-" * 150_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in S.digest(S.scan(df)).collect()}
    assert got == {0: "", 1: "", 2: "", 3: "", 4: "assign:2:16"}


def test_texts_with_very_many_matches(spark):
    """Matches of more than one chunk of the running sums, and as many that the order of the time taken shows."""
    texts = [" ".join(f"token=abc{i}def" for i in range(n)) for n in (63, 64, 65, 129, 4097, 9_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: tuple(r)[1:] for r in S.digest(S.scan(df)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert {r.doc_id: r.text for r in S.redact(df).collect()} == {
        i: " ".join([S.MARK] * n) for i, n in enumerate((63, 64, 65, 129, 4097, 9_000))}


def test_edge_rows(spark):
    docs = edge_docs(spark, clash=["found", "spans"])
    got = S.digest(S.scan(docs))
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert got.count() == docs.count() and got.where("spans <> ''").count() == 0
    assert S.digest(S.scan(empty_docs(spark))).count() == 0


def test_redaction_replaces_unions_of_spans_only(spark):
    rows = [(1, "a token = \"" + "0a1b2c3d" * 4 + "\" z", "x"), (2, None, None), (3, "clean é text", "y"), (4, "AKIA" + "Q" * 16, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, found string")
    got = {r.doc_id: (r.text, r.found) for r in S.redact(df).collect()}
    assert got == {1: ('a [SECRET]" z', "x"), 2: (None, None), 3: ("clean é text", "y"), 4: ("[SECRET]", "")}

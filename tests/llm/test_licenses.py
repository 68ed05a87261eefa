import random
import re

from helpers import edge_docs, empty_docs

from ledgerline.llm import licenses as L

KNOWN = L.templates()


def brute(text):
    t = (text or "").lower()
    units = dict.fromkeys(t.split("\n") + [b for b in re.split("\n[ \t\r]*\n", t) if "\n" in b.strip(" ")] + [t])
    out = []
    for u in units:
        g = set(L.bigrams_of(L.words_of(u)))
        scores = [2 * len(g & set(k.bigrams)) / (len(g) + len(k.bigrams)) if g else 0 for k in KNOWN]
        if max(scores) >= L.LEAST:
            out.append((KNOWN[scores.index(max(scores))].license, max(scores)))
    return len(out), ",".join(sorted({x for x, _ in out})), max((d for _, d in out), default=0.0)


def test_notices_and_texts_match_brute_force(spark):
    mit = L.TEXTS["MIT"]
    texts = [mit, "Code\n\n" + L.TEXTS["ISC"].replace("SOFTWARE", "PROGRAM", 1) + "\n\nmore", "Released under the MIT License.",
             "This work is licensed under the GNU General Public License version 2\nfoo", "licensed under cc by-nc-sa 4.0", "MIT", "mit license",
             "Released under the MIT Licence", mit.replace("Permission", "Leave").replace("Software", "thing"), mit[:len(mit) // 2],
             "the project is licensed under the Apache License, Version 2.0, and more words follow here so that it fails", L.TEXTS["Zlib"].upper()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: tuple(r)[1:] for r in L.summary(L.scan(df)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert got[0] == (1, "MIT", 1.0) and got[4][1] == "CC-BY-NC-SA-4.0" and got[5][0] == 0


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in L.summary(L.scan(docs)).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}


def test_anchors_lose_no_match():
    """What a match may miss of a template is less than its anchors touch."""
    for t in KNOWN:
        untouched = [g for g in t.bigrams if not t.anchors & set(g.split(" "))]
        assert len(untouched) < len(t.bigrams) * L.LEAST / (2 - L.LEAST)


def test_windows_find_licences_inside_longer_documents(spark):
    other = " ".join(f"other{i} words{i % 7} of the{i % 5} text" for i in range(300))
    def parts(text):
        return re.sub(r"(?<=[.:]) (?=[A-Z0-9])", "\n\n", " ".join(text.split()))
    want, texts = [], []
    for name, text in L.TEXTS.items():
        want.append(name)
        texts.append(f"{other}\n\n{parts(text)}\n\n{other}")
    want += ["MIT", "GPL-2.0", "LGPL-3.0", "Apache-2.0", "GPL-3.0,MIT", "", "MIT"]
    texts += ["Copyright 2020 The Authors. Licensed under the MIT License.", f"{other} This project is licensed under the GNU General Public License, "
              f"version 2. {other}", "(c) x y z. This project is licensed under the GNU Lesser General Public License, version 3, as is.",
              "// a line of code  SPDX-License-Identifier: Apache-2.0 */", f"{other}\n# SPDX-License-Identifier: (MIT OR GPL-3.0-or-later)\n",
              other, L.TEXTS["MIT"]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_matches, r.licenses) for r in L.summary(L.scan(df, windows=True)).collect()}
    assert [got[i][1] for i in range(len(texts))] == want
    assert got[len(texts) - 1][0] == 1
    docs = edge_docs(spark, clash=["found"])
    got = L.summary(L.scan(docs, windows=True))
    assert got.count() == docs.count() and got.where("n_matches > 0").count() == 0


def brute_windows(text):
    """The registered mode: units, then licences that only SPDX lines or word windows have."""
    t = (text or "").lower()
    found = []
    for u in dict.fromkeys(t.split("\n") + [b for b in re.split("\n[ \t\r]*\n", t) if "\n" in b.strip(" ")] + [t]):
        g = set(L.bigrams_of(L.words_of(u)))
        scores = [2 * len(g & set(k.bigrams)) / (len(g) + len(k.bigrams)) if g else 0 for k in KNOWN]
        if max(scores) >= L.LEAST:
            found.append((KNOWN[scores.index(max(scores))].license, max(scores)))
    names = {k.license.lower(): k.license for k in KNOWN}
    extra = {}
    for line in re.findall(r"(?i)SPDX-License-Identifier:[ \t]*([^\r\n]+)", text or ""):
        for x in re.findall("[A-Za-z0-9.-]+", line):
            if name := names.get(re.sub("(?i)-(only|or-later)$", "", x).lower()):
                extra[name] = 1.0
    words = L.words_of(t)
    grams = [" ".join(p) for p in zip(words, words[1:])]
    best = []
    for rank, k in enumerate(KNOWN):
        own = set(k.bigrams)
        tried = []
        for i in range(len(grams)):
            if grams[i] in own:
                w = set(grams[i:i + k.length])
                tried.append((2 * len(w & own) / (len(w) + len(own)), len(own), -rank, k.license, i, i + k.length))
        if tried and max(tried)[0] >= L.LEAST:
            best.append(max(tried))
    for x in best:
        if not any(y > x and y[4] < x[5] and x[4] < y[5] for y in best):
            extra[x[3]] = max(extra.get(x[3], 0.0), x[0])
    have = {n for n, _ in found}
    found += [(n, d) for n, d in extra.items() if n not in have]
    return len(found), ",".join(sorted({n for n, _ in found})), max((d for _, d in found), default=0.0)


def test_registered_mode_matches_brute_force(spark):
    rnd = random.Random(8)
    filler = lambda n: " ".join(rnd.choice(["the", "software", "is", "license", "of", "without", "copy", "and", "lake", "above"]) for _ in range(n))
    bodies = [*L.TEXTS.values(), *(f.format(n) for names in L.NAMES.values() for n in names for f in L.FORMS[:2])]
    texts = [None, "", "SPDX-License-Identifier: MIT AND (Apache-2.0 OR GPL-3.0-only)\nSPDX-License-Identifier: unknown-1"]
    for _ in range(60):
        parts = []
        for body in rnd.choices(bodies, k=rnd.randint(1, 2)):
            words = body.split()
            for _ in range(rnd.choice([0, 0, 1, len(words) // 12])):
                words[rnd.randrange(len(words))] = "changed"
            cut = rnd.choice([0, 0, len(words) // 10])
            parts += [filler(rnd.choice([0, 4, 60])), rnd.choice([" ", "\n", "\n\n"]).join(" ".join(words[i:i + 9]) for i in range(cut, len(words), 9))]
        texts.append(rnd.choice([" ", "\n", "\n\n"]).join([*parts, filler(rnd.choice([0, 30]))]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    got = {r.doc_id: tuple(r)[1:] for r in L.summary(L.scan(df, windows=True)).collect()}
    assert got == {i: brute_windows(t) for i, t in enumerate(texts)}
    assert sum(x[0] > 0 for x in got.values()) > 40


def test_registered_mode_on_documents_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in L.summary(L.scan(docs, windows=True)).collect()}
    assert got == {r.doc_id: brute_windows(r.text) for r in docs.collect()}


def test_edge_rows_and_empty_table(spark):
    docs = edge_docs(spark, clash=["found", "licenses"])
    got = L.summary(L.scan(docs))
    assert got.count() == docs.count() and got.where("n_matches > 0").count() == 0
    assert L.summary(L.scan(empty_docs(spark))).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

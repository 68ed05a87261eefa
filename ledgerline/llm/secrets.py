"""Secret scans in built-in column expressions only.

Three patterns find assignments, access keys and hex strings.  Beside them,
candidate strings (long runs of token characters) are scanned with a sliding
window: entering and leaving characters change a table of counts and the sum of
c * log2(c), from which the window's Shannon entropy follows without a recount.
A window over the threshold of the candidate's character class is a secret;
windows that touch make one span.  Candidates on the allow-list (words, numbers,
identifiers known to be public) are not scanned.

Positions are code points, the end exclusive.  A pattern's positions follow
from the lengths of the matches and of the pieces between them.

Defined cases: a null text has no spans, like an empty one; repeated rows are
scanned one by one; texts of any length are scanned whole; an empty table gives
an empty result; extra columns of any name pass through ``redact`` untouched.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, let

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"

WINDOW = 20
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_-="
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
# Least entropy, in bits per character, of a window of each character class.
HEX_CLASS, HEX_BITS = "[0-9a-fA-F]+", 3.0
TOKEN_BITS = 3.8
# Whole candidates that are no secrets: words, also joined; capitals; numbers; UUIDs; ruled lines.
# Repeated groups are possessive: Java's regex engine recurses once per repetition of any other, and overflows the stack.
PLAIN = "(?:[a-z]++|[A-Z][a-z]++|[A-Z]++|[0-9]{1,4}+)"
ALLOWED = "|".join([
    "[+/_=-]*+[A-Za-z]?[a-z]++(?:[+/_=-]++[A-Za-z]?[a-z]++)*+[+/_=-]*+", "[A-Z+/_=-]+", "[0-9+/_=-]+",
    "[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", f"[+/_=-]*+{PLAIN}(?:[+/_=-]++{PLAIN})*+[+/_=-]*+"])
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_token")
MARK = "[SECRET]"

CHUNK = 64  # values of a running sum that are appended to one array

EMPTY = "array<struct<s:int,e:int,v:string>>"
REGIONS = "array<struct<s:int,e:int>>"


def running(values: Column, merge=lambda a, x: a + x) -> Column:
    """Sums of an array of non-negative integers up to each of them, or its running ``merge`` (0 changes nothing).

    Chunks are summed first, so appending a value copies at most a chunk, not all values before it."""
    def along(part: Column, start: Column) -> Column:
        zero = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, zero, lambda acc, x: let(merge(acc["at"], x), lambda at: F.struct(
            at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out"))), lambda acc: acc["out"])

    def of_chunks(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), merge))
        return let(along(totals, F.lit(0)), lambda before: F.flatten(F.transform(
            chunks, lambda c, i: along(c, F.coalesce(F.get(before, i - 1), F.lit(0))))))

    return let(values, lambda v: let(F.transform(
        F.sequence(F.lit(0), F.floor((F.size(v) - 1) / CHUNK).cast("int")),
        lambda c: F.slice(v, c * CHUNK + 1, F.lit(CHUNK))), of_chunks))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (s, e, v): start, end and group of each leftmost non-overlapping match."""
    def place(parts: Column) -> Column:
        def run(found: Column) -> Column:
            value = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
            steps = F.zip_with(F.slice(parts, F.lit(1), F.size(found)), found, lambda p, f: F.length(p) + F.length(f))
            return let(value, lambda v: let(running(steps), lambda ends: F.transform(
                found, lambda f, i: let(F.get(ends, i), lambda e: F.struct(
                    (e - F.length(f)).alias("s"), e.alias("e"), F.get(v, i).alias("v"))))))
        return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), run)
    return F.when(text.rlike(pattern), let(F.split(text, pattern, -1), place)).otherwise(F.array().cast(EMPTY))


def hot_regions(candidate: Column, bits: Column) -> Column:
    """Array of (s, e) in the candidate: unions of touching windows whose entropy is at least ``bits``."""
    weight = F.array(*[F.lit(c * log2(c) if c else 0.0) for c in range(WINDOW + 2)])

    def scan(codes: Column) -> Column:
        zero = F.struct(
            F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("t"), F.lit(0).alias("i"),
            F.lit(-1).alias("s"), F.lit(-1).alias("e"), F.array().cast(REGIONS).alias("done"))

        def step(acc: Column, enter: Column) -> Column:
            def moved(leave: Column) -> Column:
                grown = F.get(acc["counts"], enter) + 1           # the entering character's new count
                rest = F.get(acc["counts"], leave) + F.when(leave == enter, 1).otherwise(0)  # the leaving one's old count
                t = acc["t"] + F.get(weight, grown) - F.get(weight, grown - 1) + F.when(
                    leave.isNull(), F.lit(0.0)).otherwise(F.get(weight, rest - 1) - F.get(weight, rest))
                counts = F.transform(acc["counts"], lambda c, k: c + F.when(k == enter, 1).otherwise(0)
                                     - F.when(k.eqNullSafe(leave), 1).otherwise(0))
                return let(t, lambda t: let(acc["i"] + 1, lambda n: let(
                    (n >= WINDOW) & (t <= WINDOW * (log2(WINDOW) - bits) + 1e-9), lambda hot: let(
                        hot & ((acc["s"] < 0) | (n - WINDOW > acc["e"])), lambda new: F.struct(
                            counts.alias("counts"), t.alias("t"), n.alias("i"),
                            F.when(new, n - WINDOW).otherwise(acc["s"]).alias("s"),
                            F.when(hot, n).otherwise(acc["e"]).alias("e"),
                            F.when(new & (acc["s"] >= 0), F.concat(acc["done"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e")))))
                             .otherwise(acc["done"]).alias("done"))))))
            return let(F.get(codes, acc["i"] - WINDOW), moved)

        return F.aggregate(codes, zero, step, lambda acc: F.when(
            acc["s"] >= 0, F.concat(acc["done"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e"))))).otherwise(acc["done"]))

    codes = F.transform(F.slice(F.split(candidate, ""), F.lit(1), F.length(candidate)),
                        lambda ch: F.instr(F.lit(ALPHABET), ch) - 1)
    return let(codes, scan)


def span(kind: int, s: Column, e: Column) -> Column:
    return F.struct(s.alias("s"), F.lit(kind).alias("k"), e.alias("e"), F.lit(KINDS[kind]).alias("kind"))


def as_span(kind: int):
    return lambda m: span(kind, m["s"], m["e"])


def of_kind(kind: int):
    return lambda x: x["k"] == kind


def spans(text: Column) -> Column:
    """All spans (s, k, e, kind) of a text in order of start, then kind."""
    def of_text(t: Column) -> Column:
        assign = F.filter(matches(t, ASSIGN, 1), lambda m: F.length(m["v"]) >= ASSIGN_MIN)
        base = F.concat(*[F.transform(found, as_span(k)) for k, found in enumerate((assign, matches(t, ACCESS), matches(t, HEX)))])
        candidates = F.filter(matches(t, CANDIDATE), lambda m: ~m["v"].rlike(f"^(?:{ALLOWED})$"))

        def regions(c: Column) -> Column:
            is_hex = c["v"].rlike(f"^{HEX_CLASS}$")
            return F.transform(
                hot_regions(c["v"], F.when(is_hex, F.lit(HEX_BITS)).otherwise(F.lit(TOKEN_BITS))),
                lambda r: F.when(is_hex, span(3, c["s"] + r["s"], c["s"] + r["e"])).otherwise(
                    span(4, c["s"] + r["s"], c["s"] + r["e"])))

        return let(base, lambda b: F.sort_array(F.concat(b, F.filter(
            F.flatten(F.transform(candidates, regions)),
            lambda x: ~F.exists(b, lambda y: (y["s"] <= x["s"]) & (x["e"] <= y["e"]))))))
    return let(F.coalesce(text.cast("string"), F.lit("")), of_text)


def listed(found: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``found``, the array of spans."""
    return docs.select(col(id_col).alias(id_col), spans(col(text_col)).alias("found"))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and digests of the base kinds, and the list of all spans."""
    found = col("found")
    base = F.filter(found, lambda x: x["k"] < 3)
    n = {kind: F.size(F.filter(found, of_kind(k))).cast("bigint").alias(f"n_{kind}") for k, kind in enumerate(KINDS[:3])}
    keep = [col(c) for c in scanned.columns if c != "found"]
    return scanned.select(*keep, *n.values(), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(found).alias("spans"))


def redacted(text: Column) -> Column:
    """The text with each union of overlapping spans replaced by ``[SECRET]``."""
    def rebuild(t: Column) -> Column:
        def joined(found: Column, to: Column) -> Column:
            def before(i: Column) -> Column:
                return F.coalesce(F.get(to, i - 1), F.lit(0))

            def chunk(first: Column) -> Column:
                """Text from the end of the spans before this chunk's to the end of its own, cut out once."""
                last = F.get(to, F.least(first + CHUNK, F.size(found)) - 1)
                return let(before(first), lambda base: let(F.substring(t, base + 1, last - base), lambda piece: F.array_join(
                    F.transform(F.slice(found, first + 1, F.lit(CHUNK)), lambda x, j: let(before(first + j), lambda at: F.when(
                        x["s"] < at, F.lit("")).otherwise(F.concat(F.substring(piece, at - base + 1, x["s"] - at), F.lit(MARK))))), "")))

            chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / CHUNK).cast("int")), lambda c: chunk(c * CHUNK))
            return F.concat(F.array_join(chunks, ""), F.substring(t, before(F.size(found)) + 1, F.length(t)))

        def ends(found: Column) -> Column:
            return running(F.transform(found, lambda x: x["e"]), lambda a, x: F.greatest(a, x))

        return let(spans(t), lambda found: F.when(F.size(found) == 0, t).otherwise(
            let(ends(found), lambda to: joined(found, to))))
    return F.when(text.isNotNull(), let(F.coalesce(text, F.lit("")), rebuild))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns, with the secrets of ``text_col`` replaced."""
    return docs.select(*[redacted(col(c)).alias(c) if c == text_col else col(c) for c in docs.columns])

"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

Everything is a column expression; no Python runs on the executors.

Base kinds are found by pattern: ``assign`` (a password, token or key that is assigned a
value of 12 characters or more), ``access`` (access key ids) and ``hex`` (runs of 16 hex
digits or more). Places follow from splitting the text at the same pattern: a match begins
after the gaps and matches in front of it.

``entropy`` spans come on top. A candidate is a run of ``CANDIDATE`` or more characters of
the base64 alphabets with a digit and a letter in it. Its character class (hexadecimal, lower
case and digits, or mixed) sets the window's width and the entropy a window must reach. The
window moves one character at a time; counts, and the sum of c * log2(c) over them, change
by the one character that enters and the one that leaves. A span reaches from the first to
the last window with enough entropy. Candidates that match the allow list (placeholders,
UUIDs, words joined by signs) and spans that lie inside a base span are left out; a span that
a base span only touches or overlaps in part stays beside it.

NULL and empty texts have no spans. Places count code points, ends are exclusive. Repeated
rows are scanned each; extra columns do not matter. Work grows with the length of a text and
the number of its matches, so a run of a million letters or 20,000 spans in a text take seconds.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
LEAST_VALUE = 12
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
# Character class, its window and the bits per character a window must reach; the first class that fits.
CLASSES = (("[0-9a-fA-F]+", 16, 2.9), ("[0-9a-z]+", 20, 3.6), ("[A-Za-z0-9+/_=-]+", 20, 3.8))
ALLOWED = (
    "[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp]laceholder|[Cc]hange_?me|[Xx]{4}|[Dd]ummy",
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "^([A-Za-z]+|[0-9]+)([-_/=+]+([A-Za-z]+|[0-9]+))+[-_/=+]*$",
)
REPLACEMENT = "[SECRET]"
NONE = "@"  # a count of none; the next characters stand for 1, 2, ...
SPAN = "array<struct<start:int,kind:int,end:int>>"
BLOCK = 256
PIECE = 1024


def no_spans() -> Column:
    return F.array().cast(SPAN)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def before_each(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each number of an array, what ``add`` makes of all before it; 0 at the first.

    Blocks of ``BLOCK`` numbers keep the arrays that grow step by step short.
    """

    def fold(items: Column, number: Callable[[Column], Column]) -> Column:
        start = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("seen"))
        return F.aggregate(items, start, lambda done, x: F.struct(add(done["total"], number(x)).alias("total"), F.concat(done["seen"], F.array(done["total"])).alias("seen")))

    def joined(blocks: Column) -> Column:
        heads = fold(blocks, lambda block: block["total"])["seen"]
        return F.flatten(F.zip_with(blocks, heads, lambda block, head: F.transform(block["seen"], lambda x: add(x, head))))

    def blocked(numbers: Column) -> Column:
        count = F.size(numbers)
        starts = F.sequence(F.lit(0), count - 1, F.lit(BLOCK))
        blocks = F.transform(starts, lambda at: fold(F.sequence(at + 1, F.least(at + BLOCK, count)), lambda place: F.element_at(numbers, place)))
        return F.when(count > 0, bound(blocks, joined)).otherwise(F.array().cast("array<int>"))

    return bound(values, blocked)


def found_at(text: Column, pattern: str, value_group: int = 0) -> Column:
    """Structs (start, end, hit, value) of all matches in order."""
    regex = F.lit(pattern)
    hits = F.regexp_extract_all(text, regex, 0)
    values = F.regexp_extract_all(text, regex, value_group) if value_group else hits
    # The last gap has no match behind it.
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"), values.alias("value"))

    def placed(x: Column, at: Column) -> Column:
        begin = at + F.length(x["gap"])
        return F.struct(begin.alias("start"), (begin + F.length(x["hit"])).alias("end"), x["hit"].alias("hit"), x["value"].alias("value"))

    def places(found: Column) -> Column:
        lengths = F.transform(found, lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0)))
        return F.filter(F.zip_with(found, before_each(lengths, Column.__add__), placed), lambda x: x["hit"].isNotNull())

    return bound(found, places)


def matches(text: Column, pattern: str, kind: int, value_group: int = 0, least: int = 0) -> Column:
    """Spans of the matches whose ``value_group`` has ``least`` characters or more."""
    kept = F.filter(found_at(text, pattern, value_group), lambda x: F.length(x["value"]) >= least)
    spans = F.transform(kept, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))
    return F.when(text.rlike(pattern), spans).otherwise(no_spans())


def hot_range(candidate: Column, width: int, least: float) -> Column:
    """First and last place (exclusive) of the windows of ``width`` with ``least`` bits or more."""
    counted = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(width + 2)))
    number = F.transform(F.regexp_extract_all(candidate, F.lit("."), 0), lambda sign: F.instr(F.lit(ALPHABET), sign) - 1)

    def worth(count: Column) -> Column:
        return F.element_at(counted, count + 1)

    def count_of(counts: Column, sign: Column) -> Column:
        return F.ascii(F.substr(counts, sign + 1, F.lit(1))) - ord(NONE)

    def changed(counts: Column, sign: Column, count: Column) -> Column:
        return F.overlay(counts, F.char(count + ord(NONE)), sign + 1, 1)

    # One character per sign of the alphabet holds its count, so that a step writes two of them.
    start = F.struct(
        F.lit(NONE * len(ALPHABET)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("at"),
        F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"),
    )

    def slide(numbers: Column) -> Column:
        def entered(done: Column, counts: Column, sum_: Column, entering: Column) -> Column:
            at, come = done["at"], count_of(counts, entering)
            total = sum_ + worth(come + 1) - worth(come)
            hot = (at >= width - 1) & (math.log2(width) - total / width >= least)
            return F.struct(
                changed(counts, entering, come + 1).alias("counts"),
                total.alias("sum"),
                (at + 1).alias("at"),
                F.when(hot & done["first"].isNull(), at - width + 1).otherwise(done["first"]).alias("first"),
                F.when(hot, at + 1).otherwise(done["last"]).alias("last"),
            )

        def left(done: Column) -> Column:
            sign = F.element_at(numbers, done["at"] - width + 1)
            gone = count_of(done["counts"], sign)
            fewer = F.struct(changed(done["counts"], sign, gone - 1).alias("counts"), (done["sum"] - worth(gone) + worth(gone - 1)).alias("sum"))
            return F.when(done["at"] >= width, fewer).otherwise(F.struct(done["counts"].alias("counts"), done["sum"].alias("sum")))

        def step(done: Column, entering: Column) -> Column:
            return bound(left(done), lambda rest: entered(done, rest["counts"], rest["sum"], entering))

        return F.aggregate(numbers, start, step, lambda done: F.struct(done["first"].alias("first"), done["last"].alias("last")))

    return bound(number, slide)


def allowed(candidate: Column) -> Column:
    """Whether the allow list has the candidate. Its last pattern is asked piece by piece: in a
    run of any length Java's matcher would take one stack frame per word."""
    words = candidate.rlike("^[A-Za-z0-9]") & candidate.rlike("[-_/=+][A-Za-z0-9]") & ~candidate.rlike("[A-Za-z][0-9]|[0-9][A-Za-z]")
    return candidate.rlike("|".join(f"(?:{a})" for a in ALLOWED[:-1])) | words


def entropy_spans(text: Column) -> Column:
    """Spans of high entropy, before they are held against the base spans."""

    def judged(found: Column) -> Column:
        hot = F.when(F.lit(False), F.struct(F.lit(0).alias("first"), F.lit(0).alias("last")))
        for pattern, width, least in CLASSES:
            hot = hot.when(found["hit"].rlike(f"^{pattern}$"), hot_range(found["hit"], width, least))
        return bound(hot, lambda hot: F.struct((found["start"] + hot["first"]).alias("start"), F.lit(KINDS.index("entropy")).alias("kind"), (found["start"] + hot["last"]).alias("end")))

    candidates = F.filter(found_at(text, CANDIDATE), lambda x: x["hit"].rlike("[0-9]") & x["hit"].rlike("[A-Za-z]") & ~allowed(x["hit"]))
    spans = F.filter(F.transform(candidates, judged), lambda s: s["start"].isNotNull())
    return F.when(text.rlike(CANDIDATE), spans).otherwise(no_spans())


def with_entropy(base: Column, entropy: Column) -> Column:
    """All spans by start and kind; entropy spans inside a base span are left out.

    Such a base span begins no later, so it stands in front: the farthest end so far decides.
    """

    def is_base(span: Column) -> Column:
        return span["kind"] < KINDS.index("entropy")

    def kept(spans: Column) -> Column:
        reach = before_each(F.transform(spans, lambda s: F.when(is_base(s), s["end"]).otherwise(0)), F.greatest)
        return F.filter(F.zip_with(spans, reach, lambda s, end: F.when(is_base(s) | (end < s["end"]), s)), lambda s: s.isNotNull())

    return bound(F.array_sort(F.concat(base, entropy)), kept)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, text, base and spans: the base spans and all spans, by start and kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"))
    found = found.withColumn("base", F.array_sort(F.concat(matches(text, ASSIGN, 0, 2, LEAST_VALUE), matches(text, ACCESS, 1), matches(text, HEX, 2))))
    return found.withColumn("spans", with_entropy(F.col("base"), entropy_spans(text)))


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*(F.lit(kind) for kind in KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def of_kind(number: int):
    return lambda kind: kind == number


def digests(found: DataFrame) -> DataFrame:
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, of_kind(i))).cast("long").alias(f"n_{kind}") for i, kind in enumerate(KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def cut_out(text: Column, spans: Column, replacement: str = REPLACEMENT) -> Column:
    """``text`` with every span, or run of overlapping spans, replaced.

    What stays is taken from pieces of ``PIECE`` characters: a substring of the whole would walk through it each time.
    """

    def part(pieces: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / PIECE).cast("int")
        near = F.slice(pieces, first + 1, F.floor(end / PIECE).cast("int") - first + 1)
        return F.substr(F.array_join(near, ""), start - first * PIECE + 1, end - start)

    def rebuilt(pieces: Column) -> Column:
        def ahead(span: Column, at: Column) -> Column:
            return F.when(span["start"] >= at, F.concat(part(pieces, at, span["start"]), F.lit(replacement))).otherwise("")

        cut = F.zip_with(spans, before_each(F.transform(spans, lambda s: s["end"]), F.greatest), ahead)
        rest = part(pieces, F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text))
        return F.array_join(F.concat(cut, F.array(rest)), "")

    return F.when(F.size(spans) > 0, bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), 0), rebuilt)).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """All documents, with secrets replaced in ``text`` and ``n_chars`` (if there) brought up to date."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.array_sort(F.concat(matches(text, ASSIGN, 0, 2, LEAST_VALUE), matches(text, ACCESS, 1), matches(text, HEX, 2)))
    marked = docs.withColumn(" base", base)
    marked = marked.withColumn(" spans", with_entropy(F.col(" base"), entropy_spans(text)))
    marked = marked.withColumn("text", cut_out(F.col("text"), F.col(" spans")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        marked = marked.withColumn("n_chars", F.when(F.size(" spans") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return marked.select(docs.columns)

"""Trees, chains and likeness against plain Python."""

import hashlib
import re

from pyspark.sql import functions as F

from tachyline.llm import merkle

SCHEMA = "doc_id long, text string, hash string, at string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(text: str) -> list:
    cut = merkle.PIECE
    return [[[sha(p[i : i + cut]) for i in range(0, max(1, len(p)), cut)] for p in s.split("\n")] for s in re.split(merkle.SECTION_BREAK, text)]


def plain_fingerprint(text: str) -> str:
    sections = []
    for section in plain_tree(text):
        paragraphs = [sha("".join(pieces)) for pieces in section]
        written = [".".join([p[:8], *(x[:8] for x in pieces)]) for p, pieces in zip(paragraphs, section, strict=True)]
        sections.append((sha("".join(paragraphs)), written))
    return ";".join([sha("".join(d for d, _ in sections)), *(",".join([d[:8], *w]) for d, w in sections)])


def plain_likeness(one: str, other: str) -> float:
    a, b = ({x[:8] for s in plain_tree(t) for p in s for x in p} for t in (one, other))
    return 2 * len(a & b) / (len(a) + len(b))


def plain(texts: list[str]) -> list[tuple]:
    out = []
    for i, text in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        k = len(text) // 4
        edited = text[: len(text) - k] + following[:k]
        out.append((len(text), sha(edited), plain_fingerprint(text), plain_fingerprint(edited), plain_likeness(text, edited), plain_likeness(text, following)))
    return out


TEXTS = ["a b c\nd e f", "", "one\n\ntwo\n \nthree", "x" * 1000, "é😀" * 300 + "\n" + "ü" * 90, "line\n" * 500, "abc", "w " * 60_000]


def test_edge_texts(spark):
    rows = [(i, t or None, "h", "1") for i, t in enumerate(TEXTS)]
    got = merkle.compare_with_edited(spark.createDataFrame(rows[::-1], SCHEMA)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == plain(TEXTS)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r["text"] for r in docs.select("text").orderBy("doc_id").collect()]
    got = merkle.compare_with_edited(docs).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == plain(texts)


def test_repeated_rows_null_ids_and_small_tables(spark):
    assert merkle.compare_with_edited(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = merkle.compare_with_edited(spark.createDataFrame([(5, "a text of its own", "", "0")], SCHEMA)).collect()
    assert tuple(alone[0])[1:] == plain(["a text of its own"])[0]
    rows = [(None, "first of all", "", "0"), (2, "twice there", "", "0"), (2, "twice there", "", "0"), (9, "the last one", "", "0")]
    got = merkle.compare_with_edited(spark.createDataFrame(rows, SCHEMA)).collect()
    want = plain(["first of all", "twice there", "the last one"])
    assert sorted((r["doc_id"] or 0, *tuple(r)[1:]) for r in got) == [(0, *want[0]), (2, *want[1]), (2, *want[1]), (9, *want[2])]
    same_id = spark.createDataFrame([(1, "here", "", "0"), (1, "there", "", "0")], SCHEMA)
    assert merkle.compare_with_edited(same_id).count() == 2


def test_edits_are_located(spark):
    one = "head\nsecond line\n\nnext section\n" + "y" * 400
    other = one.replace("second", "Second")[:-5] + "z" * 5
    row = spark.createDataFrame([(plain_fingerprint(one), plain_fingerprint(other))], "a string, b string")
    got = row.select(merkle.edited_pieces(F.col("a"), F.col("b")), merkle.edited_pieces(F.col("a"), F.col("a"))).first()
    assert list(got) == [["0.1.0", "1.1.2"], []]

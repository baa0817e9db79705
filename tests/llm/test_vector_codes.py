"""Vector codes against comparing every part with every entry in plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from tachyline.llm import vector_codes
from tachyline.llm.vector_codes import Orchard, bound_of

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """{(vec_id, place): (code, error)} and the checksum of the codebooks."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v in kept), default=0)
    width = max(-(-width // parts), 1) * parts
    kept = sorted(((i, v + [0] * (width - len(v))) for i, v in kept), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = width // parts
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, v in kept]
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]

    def nearest(part, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, entry, strict=True)), number) for number, entry in enumerate(books[part]))

    for _ in range(rounds):
        groups = [[[] for _ in book] for book in books]
        for row in cut:
            for p, x in enumerate(row):
                groups[p][nearest(p, x)[1]].append(x)
        books = [[[sum(c) // len(group) for c in zip(*group, strict=True)] if group else old for group, old in zip(groups[p], books[p], strict=True)] for p in range(parts)]
    found = [[nearest(p, x) for p, x in enumerate(row)] for row in cut]
    codes = [(i, "".join(f"{n:02x}" for _, n in row), sum(d for d, _ in row)) for (i, _), row in zip(kept, found, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return codes, digest


def got_codes(spark, rows, **how):
    coded, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA), **how)
    return vector_codes.digests(coded, books).collect()


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize(("size", "width", "spread"), [(1, 3, 5), (2, 1, 1), (40, 2, 3), (256, 16, 600), (256, 4, 2)])
def test_search_equals_all_distances(size, width, spread):
    """Also with equal entries and many ties."""
    rng = np.random.default_rng(size + width)
    entries = rng.integers(-spread, spread + 1, (size, width))
    vectors = np.concatenate([rng.integers(-spread, spread + 1, (500, width)), entries])
    distances = ((vectors[:, None] - entries) ** 2).sum(axis=2)
    number, distance = Orchard(entries).nearest(vectors)
    assert number.tolist() == distances.argmin(axis=1).tolist()  # the lowest number wins
    assert distance.tolist() == distances.min(axis=1).tolist()


def test_largest_components_fit():
    for width in (4, 64, 1000, 4096):
        bound = bound_of(width)
        assert 4 * width * (2 * bound + 2) ** 2 < 2**63 and bound > 2**20


def test_whole_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, digest = plain_codes(rows)
    got = got_codes(spark, rows)
    assert order((r["vec_id"], r["code"], r["error"]) for r in got) == order(want)
    assert {r["codebooks_sha256"] for r in got} == {digest}
    errors = {}
    labels = {r[0]: r[2] for r in rows}
    for i, _, error in want:
        errors[labels[i]] = errors.get(labels[i], 0) + error
    assert all(r["label_error"] == errors[labels[r["vec_id"]]] for r in got)


def test_odd_rows(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(60), [rng.uniform(-1, 1) for _ in range(8)], rng.choice([1, 2, None])) for _ in range(90)]
    rows += [(5, [0.5] * 8, 1)] * 200  # a hot vector
    rows += [(1, None, 1), (2, [0.1, None] * 4, 1), (3, [math.nan] * 8, 1), (4, [math.inf] + [0.0] * 7, 2), (6, [], 3), (7, [0.25] * 5, None), (None, [0.125] * 8, 3)]
    for entries in (256, 7):
        want, digest = plain_codes(rows, entries=entries)
        got = got_codes(spark, rows, entries=entries)
        assert order((r["vec_id"], r["code"], r["error"]) for r in got) == order(want)
        assert {r["codebooks_sha256"] for r in got} == {digest}


def test_length_that_parts_do_not_divide_and_huge_components(spark):
    rows = [(i, [float(i), 1e30 * (-1) ** i, 0.5, -0.5, 3e38], i % 2) for i in range(6)]
    got = got_codes(spark, rows)
    assert len(got) == 6 and all(r["error"] == 0 and len(r["code"]) == 8 for r in got)
    assert got_codes(spark, [(1, None, 1)]) == []


def test_extra_columns_and_labels_of_every_kind(spark):
    rows = [(i, [i / 7, 1.0, 2.0, 3.0], None if i % 3 == 0 else f"l{i}", "x", "y") for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string, name string, n string")
    coded, books = vector_codes.compress(frame, entries=4)
    got = coded.collect()
    assert coded.columns == ["vec_id", "label", "code", "error", "label_error"] and len(got) == 30
    none = sum(r["error"] for r in got if r["label"] is None)
    assert all(r["label_error"] == (none if r["label"] is None else r["error"]) for r in got)
    codes = np.array([list(r["code"]) for r in sorted(got)])
    decoded = books.decode(codes)
    vectors = np.floor(1024 * np.array([np.float32(r[1]) for r in rows], np.float64)).astype(np.int64)
    assert ((vectors - decoded) ** 2).sum(axis=1).tolist() == [r["error"] for r in sorted(got)]

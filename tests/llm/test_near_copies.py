"""The near-dedup stage against exact similarity over all pairs."""

import random
import time
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from tachyline import session
from tachyline.llm import near_copies

SCHEMA = "doc_id long, text string"


def plain_shingles(text: str | None) -> set[tuple[str, ...]]:
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows: list[tuple[int | None, str | None]]) -> set[tuple[int | None, str]]:
    """(doc_id, text) of the first row of each group, over all pairs of different texts."""
    first = {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(text or "", (doc_id, text))
    texts = list(first)
    sets = [plain_shingles(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            either = len(sets[i] | sets[j])
            if label[i] != label[j] and (not either or len(sets[i] & sets[j]) / either >= 0.8):
                old = label[i]
                label = [label[j] if x == old else x for x in label]
    groups = {}
    for text, name in zip(texts, label, strict=True):
        groups.setdefault(name, []).append(first[text])
    return {min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()}


def test_stage_equals_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = plain_kept([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = corpus_pipeline.near_dedup(spark, docs, "/root/testdata/sf0.01")
    assert got.columns == docs.columns
    rows = [tuple(r) for r in got.select("doc_id", "text").collect()]
    assert len(rows) == len(want) and set(rows) == want


def test_chains_of_edited_copies(spark):
    """A group whose ends are less similar than 0.8, a family below 0.8, and short texts."""
    rng = random.Random(5)

    def words(n):
        return [f"w{rng.randrange(10**6)}" for _ in range(n)]

    def edited(base, times):
        out = list(base)
        for at in rng.sample(range(0, len(out) - 5, 5), times):
            out[at] = f"x{rng.randrange(10**6)}"
        return out

    texts, base = [], words(200)
    for _ in range(8):
        texts.append(base)
        base = edited(base, 3)
    texts += [edited(texts[0], 4) for _ in range(40)]  # below 0.8 to each other, above it to their origin
    far = words(200)
    texts += [edited(far, 12) for _ in range(12)]
    texts += [["Short", "text"], ["short", "TEXT"], ["short"], []]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(100_000, None), (None, " ".join(texts[0])), (None, "alone"), (None, "alone"), (3, "another text of number three")]
    rng.shuffle(rows)
    got = [tuple(r) for r in near_copies.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()]
    want = plain_kept(rows)
    assert len(got) == len(want) and set(got) == want
    assert near_copies.keep_one(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_group_of_unlike_texts_and_common_passage(spark):
    """A passage in every text, thousands of copies of one text, and pairs on either side of the limit."""
    rng = random.Random(11)

    def words(n):
        return [f"v{rng.randrange(10**6)}" for _ in range(n)]

    passage, base = words(60), words(100)
    texts = [passage + words(60) for _ in range(300)] + [passage + words(20) for _ in range(60)]
    texts += [base[:at] + [f"z{n}"] + base[at + 1 :] for n, at in enumerate([2, 50, 97] * 40)]
    for changes in (2, 3, 5, 8):
        one = words(120)
        other = list(one)
        for at in range(0, changes * 11, 11):
            other[at + 3] = f"y{at}"
        texts += [one, other]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(10_000 + i, " ".join(base)) for i in range(2000)]
    rng.shuffle(rows)
    got = {tuple(r) for r in near_copies.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == plain_kept(rows)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c", "x", 1), (2, "A B C", "y", 2), (3, "d", "z", 3)], "doc_id long, text string, node string, key int")
    assert sorted(tuple(r) for r in near_copies.keep_one(df).collect()) == [(1, "a b c", "x", 1), (3, "d", "z", 3)]


def test_parities_never_part_similar_texts():
    """Parity bits differ in no more places than the shingle sets, whatever their sizes."""
    rng = random.Random(11)
    for size in (1, 7, 150, 5000):
        left = {b"%d" % rng.randrange(10**9) for _ in range(size)}
        for changed in (0, 1, size // 10, size // 5, size):
            right = set(sorted(left)[changed:]) | {b"x%d" % rng.randrange(10**9) for _ in range(changed)}
            one, other = (near_copies.signature(s)[2] for s in (left, right))
            apart = sum(((a ^ b) & (1 << 64) - 1).bit_count() for a, b in zip(one, other, strict=True))
            assert apart <= len(left ^ right)
            if near_copies.similarity(left, right) >= 0.8:
                assert apart * 1.8 <= (len(left) + len(right)) * 0.2 + 1e-6


def test_a_group_of_copies_passes_on_one_pair_per_node():
    """The index decides within a group; its pairs grow with the nodes, not with their square."""
    nodes = 1500
    columns = {"key": [7] * nodes, "node": range(nodes), "part": range(nodes), "size": [50] * nodes, "own": [3] * nodes, "other1": [5] * nodes}
    batch = pa.RecordBatch.from_pydict({name: pa.array(values, pa.int64()) for name, values in columns.items()})
    rows = [row for made in near_copies.candidates(iter([batch]), 2, 0.8, 1, 2048) for row in made.to_pylist()]
    pairs = [(row["a"], row["b"]) for row in rows if row["key"] is None]
    assert len(pairs) == nodes - 1 and {node for pair in pairs for node in pair} == set(range(nodes))
    assert [row["key"] for row in rows if row["key"] is not None] == [7]  # pairs were left out, so the group comes again


def test_only_nodes_of_pairs_left_out_come_again():
    """Unlike texts stay away when a group comes again; three copies among them, with one partner each, come."""
    rng = random.Random(3)
    nodes = 200
    own, other = ([rng.getrandbits(63) for _ in range(nodes)] for _ in range(2))
    for at in (50, 90):
        own[at], other[at] = own[10], other[10]
    columns = {"key": [7] * nodes, "node": range(nodes), "part": range(nodes), "size": [50] * nodes, "own": own, "other1": other}
    batch = pa.RecordBatch.from_pydict({name: pa.array(values, pa.int64()) for name, values in columns.items()})
    rows = [row for made in near_copies.candidates(iter([batch]), 2, 0.8, 1, 2048) for row in made.to_pylist()]
    (again,) = [row["nodes"] for row in rows if row["key"] is not None]
    assert len([row for row in rows if row["key"] is None]) == 2 and set(again) < {10, 50, 90} and len(again) == 2
    # A group searched in runs comes again as a whole: what lies in two runs has not met.
    rows = [row for made in near_copies.candidates(iter([batch]), 2, 0.8, 1, 64) for row in made.to_pylist()]
    assert [sorted(row["nodes"]) for row in rows if row["key"] is not None] == [list(range(nodes))]


def test_rows_that_come_again_are_those_left_out(spark):
    nodes = spark.range(40).selectExpr("id node", "array(id, -id, id * 99) prints", "5L size", "transform(sequence(1, 16), x -> id) parity")
    labels = spark.createDataFrame([(3, 1)], "node long, component long")
    key = (2 << 6) + (3 * 99 >> 58)
    left_out = spark.createDataFrame([(key, 3), (key, 4)], "key long, node long")
    rows = near_copies.in_groups(nodes, labels, left_out, 0, 3, 6, 3).collect()
    assert sorted((r["key"], r["node"], r["part"], r["own"], r["other1"], r["other2"], r["parity15"]) for r in rows) == [(key, 3, 1, 297, 3, -3, 3), (key, 4, 4, 396, 4, -4, 4)]
    assert near_copies.in_groups(nodes, labels, None, 0, 3, 6, 3).count() == 120


def test_portions_are_bounded():
    for tables in (1, 3, 27, 40, 121, 500):
        made = near_copies.portions(tables)
        assert [at for low, high in made for at in range(low, high)] == list(range(tables))
        assert all(high - low <= 28 for low, high in made)


def test_compared_texts_do_not_move(spark):
    """Texts lie in buckets: of a join with names only the names are exchanged."""
    texts = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("name"), F.repeat(F.lit("x y "), 50).alias("text"))
    names = texts.where("name < '2'").select("name", F.lit(1).alias("node"))
    with session.settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        with session.staged_buckets(texts, "name", "some-texts") as lying:
            met = names.hint("shuffle_hash").join(lying, "name")
            plan = met._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan and plan.count("Exchange") == 1 and met.count() == names.count() > 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("some_texts")]


def test_no_shuffled_rows_are_left_behind(spark):
    """Rounds drop what they shuffled when their tables are written, not when the driver collects garbage."""
    texts = [" ".join(f"u{(n * 7 + i) % 900}" for i in range(60)) for n in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], SCHEMA)

    def left():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {name for name in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in name}

    before, known = left(), {path.name for path in Path(session.scratch_dir(spark)).iterdir()}
    marked = docs.select(near_copies.node_of(docs["text"]).alias("name"), "text")
    near_copies.linked(marked)
    until = time.time() + 20
    while left() - before and time.time() < until:
        time.sleep(0.5)
    assert not left() - before
    tables = {path.name.rsplit("-", 1)[0] for path in Path(session.scratch_dir(spark)).iterdir() if path.name not in known}
    assert "nodes" in tables and not tables & {"different-texts", "signatures", "compared-texts"}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"

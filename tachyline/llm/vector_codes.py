"""Vector codes by product quantization; nearest entries are found by Orchard's search.

Vectors become integers (floor of ``SCALE`` times each component) and are cut into ``PARTS``
equal parts. Each part has a codebook of at most ``ENTRIES`` integer vectors, fitted by Lloyd
rounds over all vectors; a code is the number of the nearest entry of each part. All
arithmetic is exact, and the lower number wins a tie.

**Search.** For every entry a list of all other entries is kept, sorted by distance. A search
holds its best entry and walks that entry's list. An entry that is nearer (or as near with a
lower number) becomes the best one, and the walk goes on at the start of its list. Entries that
were compared are marked and not compared again. The walk ends where the list's distance
exceeds twice the distance to the best entry: by the triangle inequality everything beyond is
farther away than the best. All vectors of a batch walk side by side, a few list places at a
time.

**Fitting.** A round is one job: each task adds up the parts it assigned per entry and component
and passes on one row per sum, which Spark adds up. The driver gets the sums of the codebooks'
size (parts x entries x components), never vectors. Codebooks are broadcast: at most ``ENTRIES``
vectors. Cleaned vectors are staged once as a table, so no round depends on a lost executor.

Rows whose vector is NULL or holds NULL, NaN or an infinite component are dropped. A shorter
vector counts as filled up with zeros to the longest one, and to a multiple of ``PARTS``; an
empty one is all zeros. Integer components are held within a bound that depends on the length
(2**26 at 64 components) so that sums of squares fit 64 bits. The first codebooks are the vectors with the
smallest ids, rows with equal ids by their components, rows without an id last; with fewer
vectors than ``ENTRIES`` there are as many entries. Repeated rows are coded each for itself. An
empty table gives no rows. Other columns are ignored.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tachyline.session import stage

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
WALK = 16  # list places looked at together
BATCH = 2048
SEEDS = 16  # entries a search may start from
HOT_SHARE = 1000  # a label with more than one in so many rows is hot

CODES = "vec_id long, label string, code binary, error long"


def bound_of(width: int) -> int:
    """The largest magnitude of a component for which four times a squared distance fits 63 bits."""
    return (1 << (58 - max(width - 1, 1).bit_length()) // 2) - 1


class Orchard:
    """Nearest entries of one codebook (entries x components)."""

    def __init__(self, entries: np.ndarray):
        self.entries = np.asarray(entries, np.int64)
        size = len(self.entries)
        gaps = np.stack([((self.entries - entry) ** 2).sum(axis=1) for entry in self.entries]) if size else np.zeros((0, 0), np.int64)
        gaps[np.arange(size), np.arange(size)] = -1  # an entry leads its own list, which then drops it
        self.lists = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
        self.gaps = np.take_along_axis(gaps, self.lists, axis=1)
        self.seeds = np.unique(np.linspace(0, max(size - 1, 0), SEEDS).astype(np.int64))

    def distances(self, vectors: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        return ((vectors - self.entries[numbers]) ** 2).sum(axis=-1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the nearest entries and their squared distances."""
        count, last = len(vectors), self.lists.shape[1]
        marked = np.zeros((count, len(self.entries)), bool)
        first = np.stack([self.distances(vectors, seed) for seed in self.seeds], axis=1)
        best = self.seeds[first.argmin(axis=1)]
        least = first.min(axis=1)
        marked[:, self.seeds] = True
        place = np.zeros(count, np.int64)
        walking = np.arange(count if last else 0)
        while len(walking):
            places = place[walking, None] + np.arange(WALK)
            inside = places < last
            places = np.minimum(places, last - 1)
            at = best[walking, None]
            met = self.lists[at, places]
            inside &= self.gaps[at, places] <= 4 * least[walking, None]
            new = inside & ~marked[walking[:, None], met]
            found = np.full(met.shape, np.iinfo(np.int64).max)
            row, column = np.nonzero(new)
            numbers = met[row, column]
            marked[walking[row], numbers] = True
            found[row, column] = self.distances(vectors[walking[row]], numbers)
            nearest = found.min(axis=1)
            number = np.where(found == nearest[:, None], met, len(self.entries)).min(axis=1)
            better = (nearest < least[walking]) | ((nearest == least[walking]) & (number < best[walking]))
            moved = walking[better]
            best[moved], least[moved], place[moved] = number[better], nearest[better], 0
            place[walking[~better]] += WALK
            walking = walking[better | inside[:, -1]]
        return best, least


@dataclass
class Codebooks:
    """``entries`` has the shape (parts, entries, components of a part)."""

    entries: np.ndarray

    def split(self, vectors: np.ndarray) -> np.ndarray:
        """The vectors as (part, vector, component)."""
        parts, _, width = self.entries.shape
        return vectors.reshape(len(vectors), parts, width).transpose(1, 0, 2)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The vectors (in integer units) that codes (vectors x parts) stand for."""
        return np.concatenate([book[codes[:, part]] for part, book in enumerate(self.entries)], axis=1)


def whole_vectors(vectors: DataFrame, parts: int = PARTS) -> tuple[DataFrame, int]:
    """The rows that are kept (vec_id, label, whole), staged, and the length of all vectors.

    ``whole`` holds integers, filled up with zeros to that length. ``label`` is text.
    """
    plain = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["label"].cast("string").alias("label"), vectors["embedding"].cast("array<double>").alias("embedding"))
    kept = plain.where("embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND abs(x) < double('infinity'))")
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = max(-(-longest // parts), 1) * parts
    bound = bound_of(width)
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("whole", pa.list_(pa.int64()))])

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                lists = part.column(2)
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                numbers = np.clip(np.floor(lists.flatten().to_numpy() * float(SCALE)), -bound, bound).astype(np.int64)
                filled = np.zeros((len(sizes), width), np.int64)
                filled[np.arange(width) < sizes[:, None]] = numbers
                ends = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(ends, pa.array(filled.ravel()))], schema=schema)

    return stage(kept.mapInArrow(cleaned, "vec_id long, label string, whole array<long>"), "whole-vectors"), width


def matrix_of(lists: pa.ListArray, width: int) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(len(lists), width)


def first_codebooks(whole: DataFrame, width: int, parts: int, entries: int) -> Codebooks:
    """The vectors with the smallest ids as entries; only these reach the driver."""
    rows = whole.orderBy(F.asc_nulls_last("vec_id"), "whole").limit(entries).select("whole").collect()
    table = np.array([row["whole"] for row in rows], np.int64).reshape(len(rows), parts, width // parts)
    return Codebooks(np.ascontiguousarray(table.transpose(1, 0, 2)))


def moved(whole: DataFrame, width: int, books: Codebooks) -> Codebooks:
    """One Lloyd round: the floor of the mean of the parts nearest to each entry."""
    parts, entries, size = books.entries.shape
    shared = whole.sparkSession.sparkContext.broadcast(books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        search = [Orchard(book) for book in books.entries]
        totals = np.zeros((parts, entries, size + 1), np.int64)  # the last component counts
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                split = books.split(matrix_of(batch.column(0).slice(at, BATCH), width))
                for part, vectors in enumerate(split):
                    number, _ = search[part].nearest(vectors)
                    np.add.at(totals[part], number, np.concatenate([vectors, np.ones((len(vectors), 1), np.int64)], axis=1))
        used = np.flatnonzero(np.repeat(totals[..., -1] > 0, size + 1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals.ravel()[used])], names=["cell", "total"])

    rows = whole.select("whole").mapInArrow(sums, "cell long, total long").groupBy("cell").agg(F.sum("total").alias("total")).toArrow()
    shared.destroy()
    totals = np.zeros(parts * entries * (size + 1), np.int64)
    totals[rows["cell"].to_numpy()] = rows["total"].to_numpy()
    totals = totals.reshape(parts, entries, size + 1)
    counts = totals[..., -1:]
    return Codebooks(np.where(counts > 0, totals[..., :-1] // np.maximum(counts, 1), books.entries))


def fit(whole: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks from all rows of ``whole_vectors``."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte per part: 1 to 256 entries")
    books = first_codebooks(whole, width, parts, entries)
    for _ in range(rounds if books.entries.size else 0):
        books = moved(whole, width, books)
    return books


def encode(whole: DataFrame, width: int, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): one byte per part, and the squared distance to what the code stands for."""
    shared = whole.sparkSession.sparkContext.broadcast(books)
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("code", pa.binary()), ("error", pa.int64())])

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        search = [Orchard(book) for book in books.entries]
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                found = [known.nearest(vectors) for known, vectors in zip(search, books.split(matrix_of(part.column(2), width)), strict=True)]
                code = np.stack([number for number, _ in found], axis=1).astype(np.uint8)
                error = np.sum([distance for _, distance in found], axis=0)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([row.tobytes() for row in code], pa.binary()), pa.array(error)], schema=schema)

    return whole.select("vec_id", "label", "whole").mapInArrow(codes, CODES)


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows with the same label added up, rows without one together.

    At most ``HOT_SHARE`` labels can be hot; their sums are broadcast, so no task gets all rows
    of a hot label. The others are joined by label.
    """
    sums = coded.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    sums = stage(sums.select(F.coalesce("label", F.lit("")).alias("name"), F.col("label").isNull().alias("nameless"), "n", F.least("total", most).cast("long").alias("label_error")), "label-errors")
    rows = sums.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT_SHARE > rows
    hot = sums.where(is_hot).select("name", "nameless", F.col("label_error").alias("hot_error"))
    named = coded.withColumns({"name": F.coalesce("label", F.lit("")), "nameless": F.col("label").isNull()}).join(F.broadcast(hot), ["name", "nameless"], "left")
    common = named.where("hot_error IS NOT NULL").withColumnRenamed("hot_error", "label_error")
    rare = named.where("hot_error IS NULL").drop("hot_error").join(sums.where(~is_hot).select("name", "nameless", "label_error"), ["name", "nameless"])
    return common.unionByName(rare).drop("name", "nameless")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """The codes of ``vectors`` (vec_id, label, code, error, label_error) and the codebooks that read them."""
    whole, width = whole_vectors(vectors, parts)
    books = fit(whole, width, parts, entries, rounds)
    return with_label_errors(stage(encode(whole, width, books), "vector-codes")), books


def digests(coded: DataFrame, books: Codebooks) -> DataFrame:
    """The codes in hexadecimal, with a checksum of the codebooks."""
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))

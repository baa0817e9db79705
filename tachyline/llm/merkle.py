"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces of paragraphs.

Sections are parted by blank lines, paragraphs by line ends; a paragraph is read in pieces
of at most ``PIECE`` characters from its start. A piece's digest is its SHA-256; every node
above is the SHA-256 of its children's digests. The fingerprint writes the tree down: the
whole root, then the first eight hex digits of each section, paragraph and piece. Equal roots
mean equal texts, and a walk from the root into branches that differ ends at the edited
pieces (``edited_pieces``). ``likeness`` is the Dice coefficient of two trees' leaves.

Everything is a column expression; no Python runs on the executors.

``successors`` chains all documents by ascending id without a window over the whole table:
ids, text hashes and lengths (no texts) are dealt by range, each range is chained by itself,
and the last one of a range is tied to the first of the next. Texts move once, to be met by
the beginnings of their successors.

NULL texts count as empty; an empty text is one empty piece. A NULL id sorts first. Rows
with equal id and text are one document in the chain, and each reports the same; rows with
equal id and different texts are chained by the hash of the text. The successor of the last
document is the first, which may be itself. Extra columns do not matter.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tachyline.session import stage

PIECE = 160
SHORT = 8
SECTION_BREAK = "\n[ \t]*\n"
KEY = ["named", "at", "hash"]


def tree(text: Column) -> Column:
    """Digests of pieces, by section and paragraph."""

    def paragraph(p: Column) -> Column:
        last = F.floor((F.greatest(F.length(p), F.lit(1)) - 1) / PIECE).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(p.substr(i * PIECE + 1, F.lit(PIECE)).cast("binary"), 256))

    return F.transform(F.split(text, SECTION_BREAK, -1), lambda section: F.transform(F.split(section, "\n", -1), paragraph))


def node(children: Column) -> Column:
    return F.sha2(F.concat_ws("", children).cast("binary"), 256)


def fingerprint(tree_: Column) -> Column:
    """root;section,paragraph.piece.piece,paragraph...;section..."""

    def short(digests: Column) -> Column:
        return F.transform(digests, lambda digest: F.left(digest, F.lit(SHORT)))

    def paragraph(pieces: Column) -> Column:
        return F.concat_ws(".", F.array(F.left(node(pieces), F.lit(SHORT))), short(pieces))

    def section(paragraphs: Column) -> Column:
        return F.concat_ws(",", F.array(F.left(node(F.transform(paragraphs, node)), F.lit(SHORT))), F.transform(paragraphs, paragraph))

    root = node(F.transform(tree_, lambda paragraphs: node(F.transform(paragraphs, node))))
    return F.concat_ws(";", F.array(root), F.transform(tree_, section))


def leaves(tree_: Column) -> Column:
    """The different pieces of a text, by the first digits of their digests."""
    return F.array_distinct(F.transform(F.flatten(F.flatten(tree_)), lambda digest: F.left(digest, F.lit(SHORT))))


def likeness(one: Column, other: Column) -> Column:
    """Dice coefficient of two sets of leaves, neither of which is empty."""
    return 2.0 * F.size(F.array_intersect(one, other)) / (F.size(one) + F.size(other))


def edited_pieces(one: Column, other: Column) -> Column:
    """Places (section.paragraph.piece, from 0) of ``one`` whose digest differs in ``other``; both are fingerprints."""

    def parts(fp: Column) -> Column:
        return F.slice(F.split(fp, ";"), 2, F.greatest(F.size(F.split(fp, ";")) - 1, F.lit(0)))

    def below(node_: Column, sign: str) -> Column:
        children = F.split(node_, sign)
        return F.slice(children, 2, F.greatest(F.size(children) - 1, F.lit(0)))

    def differing(children: Column, others: Column, deeper) -> Column:
        """Only branches that differ are looked into."""
        return F.flatten(F.transform(children, lambda child, i: F.when(child.eqNullSafe(F.get(others, i)), F.array().cast("array<string>")).otherwise(deeper(child, F.coalesce(F.get(others, i), F.lit("")), i))))

    def section(a: Column, b: Column, i: Column) -> Column:
        return differing(below(a, ","), below(b, ","), lambda c, d, j: F.transform(paragraph(c, d), lambda k: F.concat_ws(".", i.cast("string"), j.cast("string"), k)))

    def paragraph(a: Column, b: Column) -> Column:
        return differing(below(a, "[.]"), below(b, "[.]"), lambda c, d, k: F.array(k.cast("string")))

    return F.when(one == other, F.array().cast("array<string>")).otherwise(differing(parts(one), parts(other), section))


def keyed(docs: DataFrame) -> DataFrame:
    """Texts under a key: whether there is an id, the id (or 0), and the hash of the text."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    doc_id = docs["doc_id"].cast("long")
    return docs.select(doc_id.isNotNull().alias("named"), F.coalesce(doc_id, F.lit(0).cast("long")).alias("at"), F.xxhash64(text).alias("hash"), text.alias("text"))


def successors(docs: DataFrame) -> DataFrame:
    """KEY, size and next (a struct of KEY) for every different document of ``keyed`` rows."""
    spark = docs.sparkSession
    keys = docs.groupBy(*KEY).agg(F.max(F.length("text")).alias("size"))
    ranges = stage(keys.repartitionByRange(*KEY).withColumn("part", F.spark_partition_id()), "ranges")
    # One row per partition of the step before.
    firsts = sorted(tuple(row) for row in ranges.groupBy("part").agg(F.min(F.struct(*KEY)).alias("first")).select("part", "first.*").collect())
    following = [(part, firsts[(i + 1) % len(firsts)][1:]) for i, (part, *_) in enumerate(firsts)]
    following = spark.createDataFrame(following, "part int, first struct<named: boolean, at: long, hash: long>")
    in_range = Window.partitionBy("part").orderBy(*KEY)
    chained = ranges.withColumn("next", F.lead(F.struct(*KEY)).over(in_range)).join(F.broadcast(following), "part")
    return chained.select(*KEY, "size", F.coalesce("next", "first").alias("next"))


def compare_with_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are.

    The edited text has its last quarter replaced by as much of the next document's beginning.
    """
    rows = keyed(docs)
    chain = successors(rows).select(F.struct(*KEY).alias("to"), F.floor(F.col("size") / 4).cast("int").alias("quarter"), "next.*")
    # Both joins read the same exchange of texts.
    met = rows.join(chain, KEY)
    heads = met.select("to.*", F.col("text").substr(F.lit(1), F.col("quarter")).alias("head"), leaves(tree(F.col("text"))).alias("next_leaves"))
    found = rows.join(heads.dropDuplicates(KEY), KEY)
    size = F.length("text")
    found = found.withColumn("edited", F.concat(F.col("text").substr(F.lit(1), size - F.floor(size / 4).cast("int")), "head"))
    found = found.withColumn("tree", tree(F.col("text"))).withColumn("edited_tree", tree(F.col("edited")))
    found = found.withColumn("leaves", leaves(F.col("tree"))).withColumn("edited_leaves", leaves(F.col("edited_tree")))
    return found.select(
        F.when(F.col("named"), F.col("at")).alias("doc_id"),
        size.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("tree")).alias("fingerprint"),
        fingerprint(F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(F.col("leaves"), F.col("edited_leaves")).alias("near_edited"),
        likeness(F.col("leaves"), F.col("next_leaves")).alias("near_next"),
    )

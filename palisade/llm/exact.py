"""Exact duplicates by deterministic block naming, in DataFrame operations only.

Every text is cut into blocks of equal size.  Different blocks are sorted and numbered, so a text
becomes a sequence of integer names.  Adjacent names are paired and the different pairs are numbered
the same way, level by level, until each text has one name.  Two texts are equal exactly when they
have as many blocks and the same last name: names stand for contents, not for hashes.

A 64-bit fingerprint only decides where a block is sorted and looked up.  Blocks that share a
fingerprint get different names, and are then looked up by content.

Hot contents (a block or a pair that a third of all texts has) are combined before they are shuffled,
and looked up by a join that Spark may split.  Each level is a written table; the number of levels is
the logarithm of the longest text's number of blocks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.llm.tables import Workspace

BLOCK_BYTES = 4096


def _blocks(text: Column, size: int) -> Column:
    data = F.coalesce(text, F.lit("")).cast("binary")
    last = F.greatest(F.ceil(F.octet_length(data) / size), F.lit(1)) - 1
    return F.transform(F.sequence(F.lit(0), last.cast("int")), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def _joined_names(found: DataFrame) -> DataFrame:
    """Gather the names of each row again; a row has as many as its text has blocks."""
    return found.groupBy("row").agg(
        F.first("doc").alias("doc"), F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("names")
    ).select("row", "doc", F.transform("names", lambda x: x["name"]).alias("names"))


def name_texts(
    docs: DataFrame,
    workspace: Workspace,
    *,
    block_bytes: int = BLOCK_BYTES,
    fingerprint: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """``row, doc_id, text_sha256, n_blocks, name``; (n_blocks, name) is the identity of the text.

    Null counts as the empty text, which is one empty block.  Repeated rows and repeated or null ids
    keep a row each.  An empty table gives no rows.
    """
    blocks = _blocks(F.col("text"), block_bytes)
    contents = docs.select(F.explode(blocks).alias("block")).select(fingerprint(F.col("block")).alias("print"), "block")
    names = workspace.write(
        contents.groupBy("print").agg(F.array_sort(F.collect_set("block")).alias("same"))
        .select("print", F.size("same").alias("n"), F.posexplode("same").alias("nth", "block"))
        .select("print", "nth", F.when(F.col("n") > 1, F.col("block")).alias("content"))
        .sortWithinPartitions("print", "nth")
        .select("print", F.monotonically_increasing_id().alias("name"), "content"),
        "block-names",
    )
    shared_prints = not names.filter("content IS NOT NULL").isEmpty()

    numbered = docs.select(  # before the blocks are exploded, so that a row keeps one number
        F.monotonically_increasing_id().alias("row"),
        F.struct("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha")).alias("doc"),
        blocks.alias("blocks"),
    )
    entries = numbered.select("row", "doc", F.posexplode("blocks").alias("pos", "block")).select(
        "row", F.when(F.col("pos") == 0, F.col("doc")).alias("doc"), "pos",
        fingerprint(F.col("block")).alias("print"), *(["block"] if shared_prints else []),
    )
    found = entries.join(names, "print")
    if shared_prints:
        found = found.filter(F.col("content").isNull() | (F.col("content") == F.col("block")))
    gathered = found.groupBy("row").agg(
        F.first("doc", ignorenulls=True).alias("doc"),
        F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("names"),
    )
    level = workspace.write(
        gathered.select("row", F.col("doc.doc_id"), F.col("doc.sha").alias("text_sha256"),
                        F.size("names").alias("n_blocks"), F.transform("names", lambda x: x["name"]).alias("names")),
        "level-0",
    )
    workspace.remove(names)

    kept = ["row", "doc_id", "text_sha256", "n_blocks"]
    done = level.filter(F.size("names") == 1)
    longest = level.agg(F.max("n_blocks")).first()[0] or 1
    depth = 0
    while longest > 1:
        depth += 1
        longest = (longest + 1) // 2
        longer = level.filter(F.size("names") > 1)
        halves = F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 2).cast("int"))
        pairs = longer.select(
            "row", F.struct("doc_id", "text_sha256", "n_blocks").alias("doc"),
            F.posexplode(F.transform(halves, lambda i: F.struct(
                F.get("names", 2 * i).alias("a"), F.coalesce(F.get("names", 2 * i + 1), F.lit(-1)).alias("b"),
            ))).alias("pos", "pair"),
        ).select("row", "doc", "pos", "pair.a", "pair.b")
        numbered = workspace.write(  # a written side lets Spark split a hot pair in the join
            pairs.select("a", "b").distinct().sortWithinPartitions("a", "b")
            .select("a", "b", F.monotonically_increasing_id().alias("name")),
            f"pair-names-{depth}",
        )
        level = workspace.write(
            _joined_names(pairs.join(numbered, ["a", "b"])).select("row", "doc.*", "names"), f"level-{depth}"
        )
        workspace.remove(numbered)
        done = done.unionByName(level.filter(F.size("names") == 1))
    return done.select(*kept, F.get("names", F.lit(0)).alias("name"))


def exact_duplicates(docs: DataFrame, workspace: Workspace, **settings) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: of equal texts the row of the largest doc_id stays.

    A null doc_id is smaller than any other.  Of repeated rows with one doc_id, one stays.
    """
    named = name_texts(docs, workspace, **settings)
    groups = workspace.write(  # a written side lets Spark split a hot group in the join
        named.groupBy("n_blocks", "name").agg(
            F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("keep")
        ),
        "groups",
    )
    return named.join(groups, ["n_blocks", "name"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )

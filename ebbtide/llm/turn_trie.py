"""Prefix trie of conversations: a compacted trie with a Z-fast dictionary.

A prefix of d turns is named by d and two 64-bit sums (exclusive or) of hashes that
hold each turn's place, so prefix names come from running sums. A compacted node has
an edge of depths (p, e]; its handle is the prefix of the edge's two-fattest depth,
the one that the highest power of two divides, and a dictionary keeps the nodes by
handle. A conversation finds the node where it leaves the trie by a fat binary
search: it looks up the two-fattest depth of the depths left, goes below the node
that it finds or above the depth where it finds none. So a search takes as many
steps as its length has bits, whatever the trie's size. As a lookup is a shuffle, it
asks at once for all depths that the next steps can come to, the fattest ones left.

Conversations go in by batches. All that are pending search together; edges are split
where some leave them, and of those that go on from one place with the same turn one
becomes a new leaf. The others are pending in the next batch, below that place. As the
one is picked at random the number of batches grows with the logarithm of the rows.

No conversation, node or list of members is ever held whole: turns are numbered and
summed in ranges and blocks, members are hashed from chunks in order.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.staging import stage
from ebbtide.llm.common import q

# Conversations of one family begin like its first; the longest shared beginning has FAMILY_TURNS - 1 turns.
FAMILY = 5
FAMILY_TURNS = 9
# Turns of a conversation that are summed in one block.
BLOCK_TURNS = 4096
# Depths of an edge that one row expands to at once, and ids in one chunk of members.
EDGE_DEPTHS = 4096
CHUNK_IDS = 16_384
# Steps of a fat binary search in one lookup, which asks for two to this power depths.
STEPS = 6

_EARLIER = (Window.unboundedPreceding, -1)
NODE = ["p", "pa", "pb", "e", "ea", "eb", "ca", "cb", "s"]
EDGE = ["e", "ea", "eb", "p", "pa", "pb", "ca", "cb", "r"]


def numbered_turns(rows: DataFrame) -> DataFrame:
    """(c, j, ta, tb, bytes): the turns of each conversation in order, j from 1.

    Rows are sorted over ranges of (conversation, turn); the places inside a range
    and the counts of earlier ranges give j, so one conversation may span many tasks.
    """
    ranged = stage(rows.repartitionByRange("c", "turn", "tie").withColumn("part", F.spark_partition_id()), "ranged")
    inside = Window.partitionBy("c", "part").orderBy(F.col("turn").asc_nulls_first(), "tie")
    before = Window.partitionBy("c").orderBy("part").rowsBetween(*_EARLIER)
    offsets = ranged.groupBy("c", "part").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(before)).where("before > 0")
    placed = ranged.withColumn("k", F.row_number().over(inside)).join(offsets.select("c", "part", "before"), ["c", "part"], "left")
    return placed.select("c", (F.col("k") + F.coalesce("before", F.lit(0))).cast("long").alias("j"), "ta", "tb", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, d, a, b, bytes) of rebuilt conversations, and (c, n) of all; a and b hash a turn at its place d."""
    own = turns.groupBy("c").agg(F.count("*").alias("n_own"))
    first = F.col("c") - F.col("c") % FAMILY
    shared = F.crc32(F.col("c").cast("string").cast("binary")) % FAMILY_TURNS
    plan = own.select("c", "n_own", first.alias("base"), shared.alias("h"))
    bases = own.select(F.col("c").alias("base"), F.col("n_own").alias("n_base"))
    plan = plan.join(bases, "base", "left").withColumn("lead", F.least("h", F.coalesce("n_base", F.lit(0))))
    plan = stage(plan.select("c", "base", "h", "lead", (F.col("lead") + F.greatest(F.lit(0), F.col("n_own") - F.col("h"))).alias("n")), "plan")
    led = turns.where(F.col("j") < FAMILY_TURNS).withColumnRenamed("c", "base").join(plan.where("lead > 0").select("c", "base", "lead"), "base")
    kept = turns.join(plan.select("c", "h", "lead"), "c").where("j > h")
    columns = ["ta", "tb", "bytes"]
    both = led.where("j <= lead").select("c", F.col("j").alias("d"), *columns).unionByName(
        kept.select("c", (F.col("lead") + F.col("j") - F.col("h")).alias("d"), *columns)
    )
    return both.select("c", "d", F.xxhash64("ta", "d").alias("a"), F.xxhash64("tb", "d").alias("b"), "bytes"), plan.select("c", "n")


def prefixes(turns: DataFrame) -> DataFrame:
    """(s, d, a, b, bytes, upto, na, nb): names of the first d turns, the bytes in them, and the names with the next turn.

    Sums run in blocks of turns. A last turn has no next name.
    """
    block = F.floor((F.col("d") - 1) / BLOCK_TURNS)
    cut = stage(turns.withColumn("block", block), "blocks")
    sums = lambda window: [F.bit_xor("a").over(window), F.bit_xor("b").over(window), F.sum("bytes").over(window)]
    inside = Window.partitionBy("s", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    totals = cut.groupBy("s", "block").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("bytes").alias("bytes"), F.min_by("a", "d").alias("fa"), F.min_by("b", "d").alias("fb")
    )
    blocks = Window.partitionBy("s").orderBy("block")
    following = [F.lead(c).over(blocks).alias(n) for c, n in (("fa", "a3"), ("fb", "b3"))]
    offsets = totals.select("s", "block", *[c.alias(n) for c, n in zip(sums(blocks.rowsBetween(*_EARLIER)), ("a0", "b0", "u0"))], *following)
    offsets = offsets.where("block > 0 OR a3 IS NOT NULL")
    along = Window.partitionBy("s", "block").orderBy("d")
    run = cut.select(
        "s", "d", "block", "bytes", *[c.alias(n) for c, n in zip(sums(inside), ("a1", "b1", "u1"))], *[F.lead(c).over(along).alias(n) for c, n in (("a", "a2"), ("b", "b2"))]
    )
    joined = run.join(offsets, ["s", "block"], "left")
    zero = F.lit(0).cast("long")
    named = joined.select(
        "s", "d", F.col("a1").bitwiseXOR(F.coalesce("a0", zero)).alias("a"), F.col("b1").bitwiseXOR(F.coalesce("b0", zero)).alias("b"),
        "bytes", (F.col("u1") + F.coalesce("u0", zero)).alias("upto"), F.coalesce("a2", "a3").alias("a2"), F.coalesce("b2", "b3").alias("b2"),
    )
    return named.withColumn("na", F.col("a").bitwiseXOR(F.col("a2"))).withColumn("nb", F.col("b").bitwiseXOR(F.col("b2"))).drop("a2", "b2")


def two_fattest(low: Column, high: Column) -> Column:
    """The number of (low, high] that the highest power of two divides."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return high - F.pmod(high, F.pow(F.lit(2.0), bits).cast("long"))


def _names(prefix: DataFrame, key: str, depth: str, a: str, b: str) -> DataFrame:
    """Prefix names by (key, depth), for a lookup."""
    return prefix.select(F.col("s").alias(key), F.col("d").alias(depth), F.col("a").alias(a), F.col("b").alias(b))


def _with_handles(nodes: DataFrame, prefix: DataFrame) -> DataFrame:
    """Adds the handle (f, fa, fb) and the depth c of the first prefix of the edge."""
    placed = nodes.withColumn("f", two_fattest(F.col("p"), F.col("e"))).withColumn("c", F.col("p") + 1)
    return placed.join(_names(prefix, "s", "f", "fa", "fb"), ["s", "f"])


def _edge() -> Column:
    return F.struct(*[F.col("s" if x == "r" else x).alias(x) for x in EDGE])


def _last_found(pending: DataFrame, nodes: DataFrame, prefix: DataFrame, rounds: int) -> DataFrame:
    """Adds ``edge``, that of the last node a fat binary search finds by its handle; null if it finds none.

    The search is open in the depths (low, high]. A round asks for the multiples of ``unit`` among them, 64 or so: its
    next steps look up no others until less than ``unit`` depths are left. These steps end at the deepest node found, and
    below the next multiple.
    """
    found = nodes.select("f", "fa", "fb", _edge().alias("hit"))
    own = F.struct(*pending.columns)
    state = pending.select("s", own.alias("own"), F.col("at").alias("low"), F.col("n").alias("high"), F.lit(None).cast(found.schema["hit"].dataType).alias("edge"))
    for _ in range(rounds):
        bits = F.length(F.bin(F.greatest(F.col("high") - F.col("low"), F.lit(1))))
        state = state.withColumn("unit", F.pow(F.lit(2.0), F.greatest(bits - STEPS, F.lit(0))).cast("long"))
        after = lambda depth: depth - F.pmod(depth, F.col("unit")) + F.col("unit")
        depths = F.when(after(F.col("low")) <= F.col("high"), F.sequence(after(F.col("low")), F.col("high"), F.col("unit")))
        asked = state.withColumn("f", F.explode_outer(depths)).join(_names(prefix, "s", "f", "fa", "fb"), ["s", "f"], "left")
        # Rows that have ended their search look up a name of their own that no node has, so they do not meet in one task.
        asked = asked.withColumn("f", F.coalesce("f", F.lit(-1).cast("long"))).withColumn("fa", F.coalesce("fa", "s")).withColumn("fb", F.coalesce("fb", "s"))
        answers = asked.join(found, ["f", "fa", "fb"], "left").groupBy("s").agg(
            *[F.first(x).alias(x) for x in ("own", "low", "high", "unit", "edge")], F.max_by("hit", F.when(F.col("hit").isNotNull(), F.col("f"))).alias("hit")
        )
        answers = answers.withColumn("low", F.coalesce("hit.e", "low"))
        state = answers.select("s", "own", "low", F.least(F.col("high"), after(F.col("low")) - 1).alias("high"), F.coalesce("hit", "edge").alias("edge"))
    return state.select("own.*", "edge")


def _exits(pending: DataFrame, nodes: DataFrame, prefix: DataFrame, rounds: int) -> DataFrame:
    """Where each pending conversation leaves the trie: its depth x, and the edge there if it leaves inside or at the end of one.

    ``pending`` has (s, n, a, b, at, xa, xb, na, nb): a conversation, its name, the depth of a node that it is known to
    pass, its names there and a turn further. The result has the same names for x in place of ``at``, the edge, and the
    names (ra, rb) a turn further on the edge.
    """
    state = _last_found(pending, nodes, prefix, rounds).withColumn("e", F.col("edge.e"))
    end = prefix.select("s", F.col("d").alias("e"), *[F.col(x).alias(f"e_{x}") for x in ("a", "b", "na", "nb")])
    state = state.join(end, ["s", "e"], "left")
    # The last node found is passed whole, or the conversation leaves inside its edge.
    whole = F.coalesce((F.col("e_a") == F.col("edge.ea")) & (F.col("e_b") == F.col("edge.eb")), F.lit(False))
    inside = F.col("e").isNotNull() & ~whole
    at_end = lambda new, old: F.when(whole, F.col(new)).otherwise(F.col(old)).alias(old)
    state = state.select("s", "n", "a", "b", "edge", inside.alias("inside"), *[at_end(*x) for x in (("e", "at"), ("e_a", "xa"), ("e_b", "xb"), ("e_na", "na"), ("e_nb", "nb"))])
    outside = lambda name, own: F.when(F.col("inside"), own).otherwise(F.coalesce(name, own))
    state = state.withColumn("c", outside(F.col("at") + 1, F.lit(-1))).withColumn("ca", outside(F.col("na"), F.col("s"))).withColumn("cb", outside(F.col("nb"), F.col("s")))
    state = state.join(nodes.select("c", "ca", "cb", _edge().alias("below")), ["c", "ca", "cb"], "left")
    state = state.withColumn("edge", F.when(F.col("inside"), F.col("edge")).otherwise(F.col("below")))
    state = stage(state.select("s", "n", "a", "b", "at", "xa", "xb", "na", "nb", "edge.*"), "exits")
    # How far the edge is followed: the deepest depth at which both have one name.
    walked = state.where("r IS NOT NULL").select("s", "r", F.col("p").alias("from"), F.least("e", "n").alias("to"))
    walked = walked.join(prefix.select("s", "d", "a", "b", "na", "nb"), "s").where(F.col("d").between(F.col("from") + 1, F.col("to")))
    along = prefix.select(F.col("s").alias("r"), "d", "a", "b", F.col("na").alias("ra"), F.col("nb").alias("rb"))
    same = walked.join(along, ["r", "d", "a", "b"]).groupBy("s").agg(F.max(F.struct("d", "a", "b", "na", "nb", "ra", "rb")).alias("w"))
    reached = lambda new, old: F.when(F.col("w").isNotNull(), F.col(f"w.{new}")).otherwise(F.col(old))
    return stage(
        state.join(same, "s", "left").select(
            "s", "n", "a", "b", *[reached(*x).alias(y) for *x, y in (("d", "at", "x"), ("a", "xa", "xa"), ("b", "xb", "xb"), ("na", "na", "na"), ("nb", "nb", "nb"))],
            *EDGE, "w.ra", "w.rb",
        ), "places",
    )


def _insert(here: DataFrame, nodes: DataFrame, prefix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trie with one batch in it, and what is still pending."""
    leaving = here.where("r IS NOT NULL AND x < e")
    split = leaving.select("e", "ea", "eb").distinct()
    splits = leaving.groupBy("e", "ea", "eb", "x").agg(*[F.max(x).alias(x) for x in ("p", "pa", "pb", "ca", "cb", "r", "xa", "xb", "ra", "rb")])
    along = Window.partitionBy("e", "ea", "eb").orderBy("x")
    piece = lambda last, start: F.coalesce(F.lag(last).over(along), F.col(start))
    of = lambda *columns: F.struct(*[F.col(c).alias(n) for c, n in zip(columns, NODE)])
    cuts = splits.select(
        "*", F.lead("x").over(along).isNull().alias("last"),
        *[piece(last, start).alias(f"{start}0") for last, start in (("x", "p"), ("xa", "pa"), ("xb", "pb"), ("ra", "ca"), ("rb", "cb"))],
    )
    above, rest = of("p0", "pa0", "pb0", "x", "xa", "xb", "ca0", "cb0", "r"), of("x", "xa", "xb", "e", "ea", "eb", "ra", "rb", "r")
    pieces = cuts.select(F.explode(F.when(F.col("last"), F.array(above, rest)).otherwise(F.array(above))).alias("piece")).select("piece.*")
    going = here.where("x < n")
    picked = going.groupBy("x", "xa", "xb", "na", "nb").agg(F.min_by(F.struct("s", "n", "a", "b"), F.struct(F.xxhash64("s"), "s")).alias("leaf"))
    leaves = picked.select(of("x", "xa", "xb", "leaf.n", "leaf.a", "leaf.b", "na", "nb", "leaf.s").alias("leaf")).select("leaf.*")
    added = _with_handles(pieces.unionByName(leaves), prefix)
    grown = stage(nodes.join(split, ["e", "ea", "eb"], "left_anti").unionByName(added), "nodes")
    pending = going.join(picked.select("leaf.s"), "s", "left_anti")
    return grown, stage(pending.select("s", "n", "a", "b", F.col("x").alias("at"), "xa", "xb", "na", "nb"), "pending")


def compacted(sequences: DataFrame, prefix: DataFrame) -> DataFrame:
    """The compacted nodes below the root: NODE columns, handles and depths of first prefixes."""
    zero = F.lit(0).cast("long")
    start = sequences.where("n > 0").select("s", "n", "a", "b").join(prefix.where("d = 1").select("s", F.col("a").alias("na"), F.col("b").alias("nb")), "s")
    none = sequences.limit(0).select(*[zero.alias(c) for c in [*NODE, "c", "f", "fa", "fb"]])
    first = start.select("s", "n", "a", "b", *[zero.alias(c) for c in ("x", "xa", "xb")], "na", "nb", *[F.lit(None).cast("long").alias(c) for c in (*EDGE, "ra", "rb")])
    nodes, pending = _insert(stage(first, "places"), none, prefix)
    while (longest := pending.agg(F.max(F.col("n") - F.col("at"))).first()[0]) is not None:
        nodes, pending = _insert(_exits(pending, nodes, prefix, -(-int(longest).bit_length() // STEPS)), nodes, prefix)
    return nodes


def member_hashes(members: DataFrame) -> DataFrame:
    """(n, a, b, ends_sha256): SHA-256 of the ids of the conversations that end there, ascending and comma-joined.

    Sorted ranges are joined to chunks of bounded size first; a node's chunks then go
    through one running hash in order.
    """

    def joined(batches):
        key, first, held = None, None, []
        out = lambda: pa.RecordBatch.from_pylist([{"n": key[0], "a": key[1], "b": key[2], "first": first, "ids": ",".join(held)}], schema)
        schema = pa.schema([("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
        for batch in batches:
            for n, a, b, c in zip(*(batch.column(x).to_pylist() for x in ("n", "a", "b", "c"))):
                if (n, a, b) != key or len(held) == CHUNK_IDS:
                    if held:
                        yield out()
                    key, first, held = (n, a, b), c, []
                held.append(str(c))
        if held:
            yield out()

    def hashed(batches):
        key, running = None, None
        schema = pa.schema([("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])
        out = lambda: dict(zip(("n", "a", "b", "ends_sha256"), (*key, running.hexdigest())))
        for batch in batches:
            done = []
            for n, a, b, ids in zip(*(batch.column(x).to_pylist() for x in ("n", "a", "b", "ids"))):
                if (n, a, b) != key:
                    if key:
                        done.append(out())
                    key, running = (n, a, b), hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist(done, schema)
        if key:
            yield pa.RecordBatch.from_pylist([out()], schema)

    order = ["n", "a", "b", "c"]
    chunks = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, "n long, a long, b long, first long, ids string")
    place = ["n", "a", "b", "first"]
    return chunks.repartition("n", "a", "b").sortWithinPartitions(*place).mapInArrow(hashed, "n long, a long, b long, ends_sha256 string")


def _node_totals(nodes: DataFrame, sequences: DataFrame, prefix: DataFrame) -> DataFrame:
    """Each compacted node and the root with n_convs, conv_id (smallest member), n_children, n_leaves and saved_tokens."""
    zero = F.lit(0).cast("long")
    children = nodes.groupBy("p", "pa", "pb").agg(F.count("*").alias("n_children")).select(
        F.col("p").alias("e"), F.col("pa").alias("ea"), F.col("pb").alias("eb"), "n_children"
    )
    bytes_of = prefix.groupBy("s").agg(F.sum("bytes").alias("bytes"))
    ends = sequences.select("s", "convs", F.col("n").alias("e"), F.col("a").alias("ea"), F.col("b").alias("eb"))
    ends = ends.join(children, ["e", "ea", "eb"], "left").join(bytes_of, "s", "left")
    ends = stage(ends.select("s", "convs", F.coalesce("bytes", zero).alias("bytes"), F.col("n_children").isNull().cast("long").alias("leaf")), "ends")
    # The nodes that each sequence passes. Rows are grouped by the first prefix of the edge, not by the
    # joined extent, so a node that most pass is summed on the map side of a shuffle of its own.
    passing = prefix.select("s", F.col("d").alias("e"), F.col("a").alias("ea"), F.col("b").alias("eb"), (F.col("upto") - F.col("bytes")).alias("before"))
    path = passing.join(nodes.select("e", "ea", "eb", "p", "c", "ca", "cb"), ["e", "ea", "eb"])
    at_root = sequences.select("s", *[zero.alias(x) for x in ("e", "ea", "eb", "before")], (zero - 1).alias("p"), *[zero.alias(x) for x in ("c", "ca", "cb")])
    path = stage(path.unionByName(at_root), "path")
    first = ["c", "ca", "cb"]
    sums = path.join(ends, "s").groupBy(*first).agg(
        *[F.max(x).alias(x) for x in ("e", "ea", "eb", "p", "before")], F.min("s").alias("conv_id"), F.sum("convs").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"), F.sum(F.col("convs") * (F.col("bytes") - F.col("before"))).alias("spent"),
    )
    sums = stage(sums, "sums")
    # A node's bytes are counted once, with its smallest member: that holds all depths below the first of its own nodes.
    owner = sums.groupBy(F.col("conv_id").alias("s")).agg(F.greatest(F.min("p"), zero).alias("d"))
    owner = owner.join(prefix.select("s", "d", "upto"), ["s", "d"], "left").select("s", F.coalesce("upto", zero).alias("own_from"))
    share = F.when(F.col("own_from").isNotNull(), F.col("bytes") - F.greatest("own_from", "before")).otherwise(zero)
    once = path.join(ends.join(owner, "s", "left"), "s").groupBy(*first).agg(F.sum(share).alias("once"))
    return sums.join(once, first).join(children, ["e", "ea", "eb"], "left").select(
        "e", "ea", "eb", "p", *first, "before", "conv_id", "n_convs", "n_leaves", F.coalesce("n_children", zero).alias("n_children"),
        (F.col("spent") - F.col("once")).alias("saved"),
    )


RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per node of the trie of rebuilt conversations, as in RESULT.

    Turns are ordered by turn, null first; equal turns of one conversation by md5 of role
    and text, and repeated rows are turns of their own. A null role or text is empty, a
    text of any length counts whole. Rows without conversation id belong to none and are
    left out. Ids are integers; the family of a negative id follows the sign of the
    remainder. A conversation rebuilt to no turns is a member of the root alone. Other
    columns are not read. An empty input has no conversation and gives no rows.
    """
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(q(c)), F.lit("")) for c in (role_col, text_col))
    rows = conversations.where(F.col(q(conv_col)).isNotNull()).select(
        F.col(q(conv_col)).cast("long").alias("c"), F.col(q(turn_col)).alias("turn"), F.md5(F.concat(role, F.lit("\u0000"), text)).alias("tie"),
        F.xxhash64(F.lit(1), role, text).alias("ta"), F.xxhash64(F.lit(2), role, text).alias("tb"), F.octet_length(text).cast("long").alias("bytes"),
    )
    turns, plan = rebuilt(stage(numbered_turns(rows), "turns"))
    turns = stage(turns, "rebuilt")
    zero = F.lit(0).cast("long")
    full = turns.groupBy("c").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    members = stage(plan.join(full, "c", "left").select("c", "n", F.coalesce("a", zero).alias("a"), F.coalesce("b", zero).alias("b")), "members")
    sequences = stage(members.groupBy("n", "a", "b").agg(F.min("c").alias("s"), F.count("*").alias("convs")), "sequences")
    if sequences.isEmpty():
        return spark.createDataFrame([], RESULT)
    prefix = stage(prefixes(turns.withColumnRenamed("c", "s").join(sequences.select("s"), "s", "left_semi")), "prefixes")
    nodes = compacted(sequences, prefix)
    totals = stage(_node_totals(nodes, sequences, prefix), "totals")
    hashes = member_hashes(members).select(F.col("n").alias("e"), F.col("a").alias("ea"), F.col("b").alias("eb"), "ends_sha256")
    parents = nodes.select("c", "ca", "cb", F.col("p").alias("e"), F.col("pa").alias("ea"), F.col("pb").alias("eb")).join(
        totals.select("e", "ea", "eb", F.col("conv_id").alias("above")), ["e", "ea", "eb"]
    )
    whole = stage(totals.join(hashes, ["e", "ea", "eb"], "left").join(parents.select("c", "ca", "cb", "above"), ["c", "ca", "cb"], "left"), "whole")
    nothing = F.sha2(F.lit(""), 256)
    steps = F.sequence(F.greatest(F.col("p") + 1, zero), F.col("e"), F.lit(EDGE_DEPTHS).cast("long"))
    depths = whole.withColumn("from", F.explode(steps)).withColumn(
        "d", F.explode(F.sequence(F.col("from"), F.least(F.col("e"), F.col("from") + EDGE_DEPTHS - 1)))
    )
    own = prefix.select(F.col("s").alias("conv_id"), "d", (F.col("upto") - F.col("bytes")).alias("start"))
    expanded = depths.join(own, ["conv_id", "d"], "left")
    last = F.col("d") == F.col("e")
    return expanded.select(
        "conv_id", F.col("d").alias("depth"), F.when(F.col("d") - 1 == F.col("p"), F.col("above")).when(F.col("d") > 0, F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * (F.col("before") - F.coalesce("start", F.col("before")))).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", nothing)).otherwise(nothing).alias("ends_sha256"),
    )

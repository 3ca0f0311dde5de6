"""Prefix trie of conversations: ternary search trees per range of sequences, joined at their borders.

1. Distinct turns (role, text) get dictionary ids; a conversation becomes an array of ids. The dictionary
   key is a SHA-256 of both parts, so texts are read once and never shuffled.
2. Conversations are rebuilt: one of them begins with turns of the first conversation of its block.
3. Sequences are sorted by (ids, conv_id) over range partitions. Each task cuts its range into shards of
   bounded size; equal sequences differ by conv_id, so no group is too hot to be cut.
4. A shard becomes a ternary search tree, filled from the median of its sequences outwards so that its
   branches are balanced. Nodes are numbered parents first; one pass backwards over the numbers adds up
   members, leaves and savings.
5. Only nodes on the path of a shard's first or last sequence can have members in another shard. These
   border nodes, two paths for each shard, are merged by key (a chained SHA-256 of the ids). What adds up is
   added; what counts once for each node (whether it is a leaf, its own copy of the text) is given to its first
   shard and summed along the path there.
"""

from __future__ import annotations

import hashlib
from array import array

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickermill.session import stored

BLOCK = 20  # conversations that share the first turns of their first one
HEADS = 4  # up to HEADS - 1 turns are shared
SHARD_TURNS = 200_000  # turns of a shard, but for its last conversation's
CHUNK = 500  # member ids that travel as one text to the task that hashes them
ROWS = 8192  # rows that leave a task together
NO_ENDS = hashlib.sha256(b"").hexdigest()

BOTH, FIRST, LAST = 0, 1, 2

OUT = (
    "inner boolean, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved long, ends string, task int, shard int, branch int, words long, first long"
)
NAMES = [part.split()[0] for part in OUT.split(", ")]
TYPES = [{"boolean": pa.bool_(), "binary": pa.binary(), "long": pa.int64(), "string": pa.string(), "int": pa.int32()}[part.split()[1]] for part in OUT.split(", ")]


def encoded_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, own): the (id, words) of the turns of each conversation, in the order of `turn`, null first."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = stored(
        conversations.where("conv_id is not null").select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        ),
        "turns",
    )
    entries = turns.groupBy("digest").agg(F.first("words").alias("words"))
    dictionary = stored(entries.withColumn("id", F.monotonically_increasing_id()), "dictionary")
    # Digests decide between turns of the same number, so repeated rows have a fixed order.
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "digest", "id", "words")
    own = turns.drop("words").join(dictionary, "digest").groupBy("conv_id").agg(F.array_sort(F.collect_list(place)).alias("own"))
    return stored(own.select("conv_id", F.expr("transform(own, x -> struct(x.id, x.words)) AS own")), "sequences")


def rebuilt(own: DataFrame) -> DataFrame:
    """(conv_id, ids, words): the first turns of the block's first conversation, then the own turns after as many."""
    heads = own.where(f"conv_id % {BLOCK} = 0").select(F.col("conv_id").alias("base"), F.expr(f"slice(own, 1, {HEADS - 1}) AS head"))
    placed = own.withColumns(
        {"base": F.expr(f"conv_id - conv_id % {BLOCK}"), "h": F.expr(f"int(crc32(string(conv_id)) % {HEADS})")}
    )
    joined = placed.join(heads, "base", "left").withColumn("head", F.expr("slice(head, 1, h)"))
    tail = F.expr("slice(own, h + 1, size(own))")
    turns = joined.select("conv_id", F.when(F.col("head").isNull(), tail).otherwise(F.concat("head", tail)).alias("s"))
    return turns.select("conv_id", F.col("s.id").alias("ids"), F.col("s.words").alias("words"))


class _Tree:
    """Ternary search tree of one shard. Node 0 is the root; `down` is the first of a node's children.

    Children of a node hang below each other by `less` and `more`; parents have smaller numbers.
    """

    def __init__(self):
        self.value, self.parent, self.depth = array("q", [0]), array("q", [-1]), array("q", [0])
        self.down, self.less, self.more = array("q", [-1]), array("q", [-1]), array("q", [-1])
        self.words, self.count, self.least = array("q", [0]), array("q", [0]), array("q", [0])
        self.ends: dict[int, tuple[int, int]] = {}

    def _new(self, value: int, parent: int, words: int) -> int:
        for column, entry in (
            (self.value, value), (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.words, words),
            (self.down, -1), (self.less, -1), (self.more, -1), (self.count, 0), (self.least, 0),
        ):
            column.append(entry)
        return len(self.value) - 1

    def insert(self, ids: list[int], words: list[int], start: int, end: int, least: int) -> None:
        """A sequence that rows `start` to before `end` have, `least` being their smallest conversation."""
        value, down, less, more = self.value, self.down, self.less, self.more
        node, path = 0, [0]
        for number, size in zip(ids, words):
            at = down[node]
            if at < 0:
                at = down[node] = self._new(number, node, size)
            else:
                while value[at] != number:
                    side = less if number < value[at] else more
                    if side[at] < 0:
                        side[at] = self._new(number, node, size)
                    at = side[at]
            node = at
            path.append(at)
        for at in path:
            self.least[at] = min(self.least[at], least) if self.count[at] else least
            self.count[at] += end - start
        self.ends[node] = (start, end)

    def path(self, ids: list[int]) -> list[int]:
        """Nodes from the root along a sequence that is in the tree."""
        out = [0]
        for number in ids:
            at = self.down[out[-1]]
            while self.value[at] != number:
                at = self.less[at] if number < self.value[at] else self.more[at]
            out.append(at)
        return out


def _medians(size: int):
    """0 to size - 1, each range's median before its halves."""
    waiting = [(0, size)]
    while waiting:
        low, high = waiting.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            waiting += [(middle + 1, high), (low, middle)]


def _shard_rows(convs: list[int], ids: list[list[int]], words: list[list[int]], task: int, shard: int):
    """Rows of OUT for the sorted sequences of one shard: inner nodes complete, border nodes in part."""
    cuts = [k for k in range(len(ids)) if not k or ids[k] != ids[k - 1]] + [len(ids)]
    tree = _Tree()
    for k in _medians(len(cuts) - 1):
        start = cuts[k]
        tree.insert(ids[start], words[start], start, cuts[k + 1], convs[start])

    branch: dict[int, int] = {}
    keys: dict[int, bytes] = {0: hashlib.sha256(b"").digest()}
    for side, sequence in ((FIRST, ids[0]), (LAST, ids[-1])):
        for at in tree.path(sequence):
            branch[at] = BOTH if at in branch else side
            if at:
                keys[at] = hashlib.sha256(keys[tree.parent[at]] + tree.value[at].to_bytes(8, "little")).digest()

    size = len(tree.value)
    children, leaves, saved = (array("q", bytes(8 * size)) for _ in range(3))
    for at in range(size - 1, -1, -1):
        if at in branch:
            # Its leaf and the one copy that is not saved are counted when all shards are known.
            saved[at] += tree.count[at] * tree.words[at]
        else:
            saved[at] += (tree.count[at] - 1) * tree.words[at]
            leaves[at] += not children[at]
        above = tree.parent[at]
        if above >= 0:
            children[above] += at not in branch
            leaves[above] += leaves[at]
            saved[above] += saved[at]

    for at in range(size):
        start, end = tree.ends.get(at, (0, 0))
        above = tree.parent[at]
        common = (tree.least[at], tree.depth[at])
        sums = (tree.count[at], children[at], leaves[at], saved[at])
        if at not in branch:
            ends = hashlib.sha256(",".join(map(str, convs[start:end])).encode()).hexdigest() if end else NO_ENDS
            known = (keys[above], None) if above in branch else (None, tree.least[above])
            yield True, None, known[0], *common, known[1], *sums, ends, None, None, None, None, None
        else:
            mine = keys[at], keys.get(above)
            yield False, *mine, *common, None, *sums, None, task, shard, branch[at], tree.words[at], None
            for k in range(start, end, CHUNK):
                text = ",".join(map(str, convs[k : min(k + CHUNK, end)]))
                yield False, *mine, *common, None, 0, 0, 0, 0, text, task, shard, None, None, convs[k]


def _shards(batches, shard_turns: int):
    """Sorted (conv_id, ids, words) batches of one task to rows of OUT, shard by shard."""
    task, shard, turns = TaskContext.get().partitionId(), 0, 0
    convs, ids, words = [], [], []

    def leave():
        waiting = []
        for row in _shard_rows(convs, ids, words, task, shard):
            waiting.append(row)
            if len(waiting) == ROWS:
                yield _batch(waiting)
                waiting = []
        if waiting:
            yield _batch(waiting)

    for batch in batches:
        for conv, own, sizes in zip(*(column.to_pylist() for column in batch.columns)):
            convs.append(conv)
            ids.append(own)
            words.append(sizes)
            turns += len(own) + 1
            if turns >= shard_turns:
                yield from leave()
                convs, ids, words, turns, shard = [], [], [], 0, shard + 1
    if convs:
        yield from leave()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), TYPES)], NAMES)


def _hashed(batches):
    """SHA-256 of the member ids of each key from chunks in order; only one key's state is held."""
    key, state = None, None
    for batch in batches:
        out = []
        for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if own != key:
                if state:
                    out.append((key, state.hexdigest()))
                key, state = own, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if out:
            yield _digests(out)
    if state:
        yield _digests([(key, state.hexdigest())])


def _digests(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.string()))], ["key", "ends_sha256"])


def _border_nodes(made: DataFrame) -> DataFrame:
    """Border nodes of all shards merged: (key, parent_key, conv_id, depth, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    parts = made.where("not inner and branch is not null")
    merged = parts.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner_children"),
        F.min(F.struct("task", "shard")).alias("owner"),
    )
    merged = stored(merged, "border")
    below = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("border_children"))
    nodes = merged.join(below.where("key is not null"), "key", "left")
    nodes = stored(
        nodes.withColumn("n_children", F.col("inner_children") + F.coalesce("border_children", F.lit(0))).drop("inner_children", "border_children"),
        "border",
    )

    # What counts once for a node counts in its first shard; there its border descendants lie further along the path.
    owned = F.col("owner") == F.struct("task", "shard")
    own = parts.drop("n_children").join(nodes.select("key", "owner", "n_children"), "key").withColumns(
        {
            "leaf": F.when(owned & (F.col("n_children") == 0), 1).otherwise(0),
            "copy": F.when(owned, F.col("words")).otherwise(0),
        }
    )
    along = Window.partitionBy("task", "shard", "branch").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    shard = Window.partitionBy("task", "shard")
    forks = lambda c: F.when(F.col("branch") == BOTH, F.sum(F.when(F.col("branch") != BOTH, F.col(c)).otherwise(0)).over(shard)).otherwise(0)
    summed = own.withColumns({c: F.sum(c).over(along) + forks(c) for c in ("leaf", "copy")})
    sums = summed.groupBy("key").agg(
        F.sum(F.col("n_leaves") + F.col("leaf")).alias("n_leaves"), F.sum(F.col("saved") - F.col("copy")).alias("saved_tokens")
    )

    chunks = made.where("not inner and first is not null").select("key", "ends", "first")
    digests = chunks.repartition("key").sortWithinPartitions("key", "first").select("key", "ends").mapInArrow(
        _hashed, "key binary, ends_sha256 string"
    )
    out = nodes.drop("owner").join(sums, "key").join(digests, "key", "left")
    return stored(out.na.fill(NO_ENDS, ["ends_sha256"]), "border")


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Per node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversation c begins with the first crc32(c) % 4 turns of conversation c - c % 20 (all if it has fewer,
    none if it does not exist) and goes on with its own turns after as many. A node is a distinct sequence of first turns (role,
    text), the root being the empty one; conv_id is its smallest member. saved_tokens counts, over the
    subtree, the words of a node's last turn for all members but one; ends_sha256 is over the ascending
    ids of the members that end there, comma-joined.

    Null role and text count as ''; turns are in the order of `turn`, null first, equal numbers by a digest of
    role and text; repeated rows are turns of their own; rows without a conv_id are left out; other columns are
    ignored; no rows give no nodes. Texts of any length are read whole. The turns of one
    conversation travel as one array of 16 bytes a turn.
    """
    sequences = rebuilt(encoded_turns(conversations))
    order = ["ids", "conv_id"]
    dealt = sequences.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "ids", "words")
    made = stored(dealt.mapInArrow(lambda batches: _shards(batches, shard_turns), OUT), "nodes")
    border = _border_nodes(made)
    parents = border.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    final = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = made.where("inner").withColumnsRenamed({"saved": "saved_tokens", "ends": "ends_sha256"})
    below = inner.where("parent_key is not null").drop("parent_conv_id").join(parents, "parent_key")
    return (
        inner.where("parent_key is null").select(*final)
        .unionByName(below.select(*final))
        .unionByName(border.join(parents, "parent_key", "left").select(*final))
    )

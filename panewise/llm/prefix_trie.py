"""Prefix trie of conversations: every distinct sequence of first turns, and what it would save.

A turn is known by 16 bytes of the SHA-256 of its role and text, so texts are hashed where they
lie and never shuffled; a conversation travels as the digests of its turns and their word counts.
Conversations are sorted by that sequence, then by number, and cut into range shards of bounded
size. Each shard encodes its turns by a dictionary of its own and builds a ternary search tree: in
it a node has the turns that come before and after its own on either side, and those that follow
it below. Sequences are inserted median first, which balances the sides. One iterative traversal
then adds up members, leaves and savings.

Only the nodes on the path of a shard's first and last sequence can have members in other shards.
They go on as at most two sequences a shard, with what they have gathered, and are merged in the
same way: sorted, cut into shards, inserted, until one shard is left. So a very common first turn,
or a third of all conversations being alike, is as many shards as it needs.

The turns of a conversation are ordered by number, null first, equal numbers by digest; null roles
and texts count as empty. Repeated rows are turns like any other. Rows without a conversation are
left out, and further columns are ignored. A conversation is one row: 24 bytes a turn, however
long its texts are. An empty table gives no nodes, not even a root.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panewise.llm.tables import stored

WIDTH = 16  # bytes of a turn's digest
SHARD_TURNS = 1 << 17  # turns that one shard holds, and no more than the sequence that passes it
SHARD_ROWS = 8  # sequences that a shard holds at least, so that every merge leaves fewer of them

NODE, PATH, SEGMENT = 0, 1, 2
GATHERED = ("members", "least", "children", "leaves", "saved")
SCHEMA = (
    "kind int, node binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, segment string, seq binary, "
    "words array<bigint>, " + ", ".join(f"{name} array<bigint>" for name in GATHERED)
)
_LONGS = pa.list_(pa.int64())
ARROW = pa.schema(
    [("kind", pa.int32()), ("node", pa.binary()), ("parent", pa.binary())]
    + [(name, pa.int64()) for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string()), ("segment", pa.string()), ("seq", pa.binary()), ("words", _LONGS)]
    + [(name, _LONGS) for name in GATHERED]
)
NOTHING = sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as (digest, words)."""
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, WIDTH)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    turns = conversations.where("conv_id is not null").select(
        "conv_id", F.struct("turn", digest.alias("digest"), words.alias("words")).alias("turn")
    )
    held = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return held.withColumn("turns", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))))


def with_borrowed_start(turns: DataFrame, lender: Column, count: Column) -> DataFrame:
    """Conversations whose first ``count`` turns are replaced by the first of those of ``lender``.

    ``count`` is three at most. A lender that is missing or shorter gives what it has.
    """
    asked = turns.select("conv_id", "turns", lender.alias("_lender"), count.cast("int").alias("_count"))
    starts = turns.select(F.col("conv_id").alias("_lender"), F.slice("turns", 1, 3).alias("_start"))
    start = F.coalesce(F.slice("_start", F.lit(1), F.col("_count")), F.array().cast(turns.schema["turns"].dataType))
    rest = F.slice("turns", F.col("_count") + 1, F.size("turns"))
    return asked.join(starts, "_lender", "left").select("conv_id", F.concat(start, rest).alias("turns"))


class Shard:
    """A ternary search tree over sorted sequences. Node 0 is the root, which has no turn."""

    def __init__(self, rows: list[dict], level: int, last: bool) -> None:
        self.rows, self.level, self.last = rows, level, last
        turns = {row["seq"][k : k + WIDTH] for row in rows for k in range(0, len(row["seq"]), WIDTH)}
        self.code = {digest: number for number, digest in enumerate(sorted(turns))}
        self.turn: list[int] = []
        self.before: list[int] = []
        self.below: list[int] = []
        self.after: list[int] = []
        self.above: list[int] = []
        self.depth: list[int] = []
        self.words: list[int] = []
        self.gathered: dict[str, list] = {name: [] for name in GATHERED}
        self._node(-1, -1, 0, 0)
        self.paths: dict[int, list[int]] = {}
        for row in _medians_first(len(rows)):
            self.paths[row] = self._insert(rows[row])
        ends = (self.paths[0], self.paths[len(rows) - 1])
        self.border = {} if last else {node: None for path in ends for node in path}
        self.keys: dict[int, bytes] = {}
        for row in range(len(rows)) if level else {0, len(rows) - 1}:
            self.keys.update(zip(self.paths[row], _prefix_keys(rows[row]["seq"]), strict=True))

    def _node(self, turn: int, above: int, depth: int, words: int) -> int:
        for values, value in (
            (self.turn, turn), (self.before, -1), (self.below, -1), (self.after, -1),
            (self.above, above), (self.depth, depth), (self.words, words),
        ):
            values.append(value)
        for name, values in self.gathered.items():
            values.append(None if name == "least" else 0)
        return len(self.turn) - 1

    def _insert(self, row: dict) -> list[int]:
        """Add a sequence and what it has gathered per depth. Returns its nodes from the root down."""
        at, path = 0, [0]
        for depth in range(1, len(row["words"]) + 1):
            turn = self.code[row["seq"][(depth - 1) * WIDTH : depth * WIDTH]]
            sides, parent = self.below, at
            place, node = at, self.below[at]
            while node >= 0 and self.turn[node] != turn:
                sides, place = (self.before if turn < self.turn[node] else self.after), node
                node = sides[place]
            if node < 0:
                node = sides[place] = self._node(turn, parent, depth, row["words"][depth - 1])
            at = node
            path.append(node)
        for name, values in self.gathered.items():
            for node, value in zip(path, row[name], strict=True):
                if name != "least":
                    values[node] += value
                elif value is not None and (values[node] is None or value < values[node]):
                    values[node] = value
        return path

    def _from_the_top(self) -> list[int]:
        """All nodes, each after the one it follows."""
        order, waiting = [], [0]
        while waiting:
            node = waiting.pop()
            order.append(node)
            waiting += [n for n in (self.before[node], self.after[node], self.below[node]) if n >= 0]
        return order

    def add_up(self) -> list[int]:
        """Add leaves and savings up from the bottom, border nodes left open. Returns the other nodes."""
        children, leaves, saved = (self.gathered[name] for name in ("children", "leaves", "saved"))
        members, done = self.gathered["members"], []
        for node in reversed(self._from_the_top()):
            if node in self.border:
                continue
            done.append(node)
            if not children[node]:
                leaves[node] = 1
            saved[node] += (members[node] - 1) * self.words[node]
            above = self.above[node]
            if above >= 0:
                children[above] += 1
                leaves[above] += leaves[node]
                saved[above] += saved[node]
        return done


def _medians_first(count: int) -> Iterator[int]:
    """All numbers below ``count``: the middle, then the middles of both sides, and so on."""
    waiting = [(0, count)]
    while waiting:
        start, end = waiting.pop()
        if start < end:
            middle = (start + end) // 2
            yield middle
            waiting += [(start, middle), (middle + 1, end)]


def _prefix_keys(seq: bytes) -> list[bytes]:
    """The key of every prefix of a sequence, from the empty one on."""
    state = sha256()
    keys = [state.digest()[:WIDTH]]
    for at in range(0, len(seq), WIDTH):
        state.update(seq[at : at + WIDTH])
        keys.append(state.digest()[:WIDTH])
    return keys


def _batch(columns: dict[str, list]) -> pa.RecordBatch:
    count = len(next(iter(columns.values())))
    return pa.record_batch([pa.array(columns.get(f.name, [None] * count), f.type) for f in ARROW], schema=ARROW)


def _shard_rows(rows: list[dict], level: int, last: bool) -> Iterator[pa.RecordBatch]:
    shard = Shard(rows, level, last)
    done = shard.add_up()
    gathered, border, keys = shard.gathered, shard.border, shard.keys
    least = gathered["least"]
    ends: dict[int, list[int]] = {}
    for number, row in enumerate(rows if level == 0 else []):
        ends.setdefault(shard.paths[number][-1], []).extend(row["ends"])
    above = [shard.above[node] for node in done]
    open_above = [node in border for node in above]
    yield _batch(
        {
            "kind": [NODE] * len(done),
            "node": [keys.get(node) for node in done],
            "parent": [keys[node] if is_open else None for node, is_open in zip(above, open_above, strict=True)],
            "conv_id": [least[node] for node in done],
            "depth": [shard.depth[node] for node in done],
            "parent_conv_id": [None if is_open or node < 0 else least[node] for node, is_open in zip(above, open_above, strict=True)],
            "n_convs": [gathered["members"][node] for node in done],
            "n_children": [gathered["children"][node] for node in done],
            "n_leaves": [gathered["leaves"][node] for node in done],
            "saved_tokens": [gathered["saved"][node] for node in done],
            "ends_sha256": [sha256(_joined(ends.get(node, []))).hexdigest() if level == 0 else None for node in done],
        }
    )
    segments = [(keys[node], held) for node, held in ends.items() if node in border]
    if segments:
        yield _batch(
            {
                "kind": [SEGMENT] * len(segments),
                "node": [key for key, _ in segments],
                "conv_id": [held[0] for _, held in segments],
                "segment": [_joined(held).decode() for _, held in segments],
            }
        )
    if border:
        given: set[int] = set()
        for number in (0, len(rows) - 1):
            path = shard.paths[number]
            if given.issuperset(path):
                continue  # the first sequence, or one that begins it
            fresh = [node not in given for node in path]
            given.update(path)
            blank = {name: None if name == "least" else 0 for name in GATHERED}
            yield _batch(
                {"kind": [PATH], "seq": [rows[number]["seq"]], "words": [rows[number]["words"]]}
                | {
                    name: [[gathered[name][node] if new else blank[name] for node, new in zip(path, fresh, strict=True)]]
                    for name in GATHERED
                }
            )


def _joined(conv_ids: list[int]) -> bytes:
    return ",".join(map(str, conv_ids)).encode()


def _alike(rows: Iterator[dict], most: int) -> Iterator[dict]:
    """Conversations (seq, words, conv_id), sorted, as sequences with their members, ``most`` at most each."""
    current: dict | None = None
    for row in rows:
        if current is None or row["seq"] != current["seq"] or len(current["ends"]) >= most:
            if current is not None:
                yield current
            current = {"seq": row["seq"], "words": row["words"], "ends": []}
        current["ends"].append(row["conv_id"])
    if current is not None:
        yield current


def _shards(level: int, last: bool, turns: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cut sorted rows into shards, and give out their nodes, open paths and segments of members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        held, size = [], 0
        for row in rows if level else _alike(rows, turns):
            deep = len(row["words"]) + 1
            weight = deep if level else max(deep, len(row["ends"]))
            if not last and size + weight > turns and len(held) >= SHARD_ROWS:
                yield from _shard_rows(held, level, last)
                held, size = [], 0
            if level == 0:
                row |= {"members": [len(row["ends"])] * deep, "least": [row["ends"][0]] * deep}
                row |= {name: [0] * deep for name in ("children", "leaves", "saved")}
            held.append(row)
            size += weight
        if held:
            yield from _shard_rows(held, level, last)

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends_sha256) from rows (node, first, segment) sorted by both: one digest as they stream through."""
    current, state = None, sha256()
    for batch in batches:
        nodes, digests = [], []
        for node, segment in zip(batch.column("node").to_pylist(), batch.column("segment").to_pylist(), strict=True):
            if node != current:
                if current is not None:
                    nodes.append(current)
                    digests.append(state.hexdigest())
                current, state = node, sha256()
            else:
                state.update(b",")
            state.update(segment.encode())
        yield pa.record_batch([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
    if current is not None:
        yield pa.record_batch([pa.array([current], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


def prefix_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 (of the numbers of the members that end there, in order, comma-joined).

    ``turns`` has (conv_id, turns), one row per conversation, as ``ordered_turns`` gives it.
    """
    seq = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    rows = stored(turns.select("conv_id", seq.alias("seq"), F.col("turns.words").alias("words")), "sequences")
    tasks = turns.sparkSession.sparkContext.defaultParallelism
    levels = []
    while True:
        level = len(levels)
        count, total = rows.agg(F.count(F.lit(1)), F.sum(F.size("words") + 1)).first()
        order = ["seq", "conv_id"] if level == 0 else ["seq"]
        last = level > 0 and (count <= SHARD_ROWS or total <= shard_turns)
        parts = max(1, -(-(total or 0) // shard_turns))
        # Enough rows in each part that merging them leaves fewer, whatever their number of turns.
        parts = max(tasks, parts) if level == 0 else min(parts, -(-count // (4 * SHARD_ROWS)))
        dealt = rows.repartition(1) if last else rows.repartitionByRange(parts, *order)
        found = stored(
            dealt.sortWithinPartitions(*order).mapInArrow(_shards(level, last, shard_turns), SCHEMA), f"trie-{level}"
        )
        levels.append(found.where(F.col("kind") == NODE))
        if level == 0:
            segments = found.where(F.col("kind") == SEGMENT)
        if last:
            break
        rows = found.where(F.col("kind") == PATH).select("seq", "words", *GATHERED)
    return _named(levels, segments)


def _named(levels: list[DataFrame], segments: DataFrame) -> DataFrame:
    """Give merged nodes the digest of their members, and nodes below them the number of their parent."""
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    merged = levels[1]
    for level in levels[2:]:
        merged = merged.unionByName(level)
    # A node that very many conversations end at is a few large segments, and one pass over their bytes.
    dealt = segments.select("node", "conv_id", "segment").repartition("node").sortWithinPartitions("node", "conv_id")
    ends = dealt.mapInArrow(_digests, "node binary, ends_sha256 string")
    merged = merged.drop("ends_sha256").join(ends, "node", "left")
    merged = merged.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    merged = stored(merged.select("node", "parent", *columns), "merged")
    nodes = levels[0].select("parent", *columns).unionByName(merged.select("parent", *columns))
    parents = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("_above"))
    below = nodes.where("parent is not null").join(parents, "parent").withColumn("parent_conv_id", F.col("_above"))
    return nodes.where("parent is null").select(*columns).unionByName(below.select(*columns))

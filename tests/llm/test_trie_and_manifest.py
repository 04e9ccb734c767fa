"""The prefix trie and the Merkle manifest against brute force."""

import random
import re
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from panewise.llm import merkle, prefix_trie
from panewise.llm.tables import fold

TURNS = "conv_id bigint, turn bigint, role string, text string"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, tree string, position int"


def digest(text):
    return sha256(text.encode()).hexdigest()


def brute_trie(rows):
    convs = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            key = sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()
            convs.setdefault(conv_id, []).append(((turn is not None, turn or 0), key, role or "", text or ""))
    built = {}
    for conv_id, turns in convs.items():
        h = zlib.crc32(str(conv_id).encode()) % 4
        lent = sorted(convs.get(conv_id - conv_id % 20, []))[:h]
        built[conv_id] = tuple((role, text) for _, _, role, text in [*lent, *sorted(turns)[h:]])
    members = {}
    for conv_id, turns in built.items():
        for depth in range(len(turns) + 1):
            members.setdefault(turns[:depth], []).append(conv_id)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, inside in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for depth in range(len(node) + 1):
            saved[node[:depth]] += (len(inside) - 1) * words
            leaves[node[:depth]] += node not in children
    out = []
    for node, inside in members.items():
        ends = ",".join(str(c) for c in sorted(inside) if len(built[c]) == len(node))
        above = min(members[node[:-1]]) if node else None
        counts = (len(inside), len(children.get(node, [])), leaves[node], saved[node])
        out.append((min(inside), len(node), above, *counts, digest(ends)))
    return sorted(out, key=str)


def conversations():
    """Conversations of all lengths, many alike, some deep, with odd rows."""
    rng, rows = random.Random(1), []
    for conv_id in range(400):
        if conv_id % 3 == 0:
            rows += [(conv_id, t, "user", "hot one") for t in range(2)]  # a third are alike
            continue
        for turn in range(rng.choice([1, 2, 3, 4, 6, 40])):
            rows.append((conv_id, turn, "user" if turn % 2 else None, rng.choice(["a b", "c", "", None, "same same same"])))
    rows += [(None, 1, "x", "y"), (5, None, "r", "first"), (5, None, "r", "first"), (7, 3, None, None)]
    return [*rows, (1001, 0, "u", "word " * 50_000), (1002, 0, "u", "x")]


@pytest.mark.parametrize("shard", [prefix_trie.SHARD_TURNS, 200, 10])
@pytest.mark.parametrize("rows", [conversations(), conversations()[:1], []], ids=["many", "one", "none"])
def test_trie_equals_brute_force(spark, rows, shard):
    frame = spark.createDataFrame(rows, TURNS).withColumn("seq", F.lit("x")).withColumn("node", F.lit(1))
    turns = prefix_trie.ordered_turns(frame)
    conv_id = F.col("conv_id")
    rebuilt = prefix_trie.with_borrowed_start(turns, conv_id - conv_id % 20, fold("conv_id", 4))
    found = sorted((tuple(r) for r in prefix_trie.prefix_trie(rebuilt, shard).collect()), key=str)
    assert found == brute_trie(rows)


def test_a_shard_is_balanced():
    rows = [
        {"seq": bytes([k // 256, k % 256]) * 8, "words": [1], "members": [1, 1], "least": [k, k], "ends": [k]}
        | {name: [0, 0] for name in ("children", "leaves", "saved")}
        for k in range(1000)
    ]
    shard = prefix_trie.Shard(rows, 0, True)
    depth, deepest, waiting = {shard.below[0]: 1}, 0, [shard.below[0]]
    while waiting:
        node = waiting.pop()
        deepest = max(deepest, depth[node])
        for side in (shard.before[node], shard.after[node]):
            if side >= 0:
                depth[side] = depth[node] + 1
                waiting.append(side)
    assert len(depth) == 1000 and deepest <= 10


def climb(nodes):
    """The root over nodes, and for each the steps that lead to it: (side of the sibling, sibling)."""
    steps, groups = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        above, merged = [], []
        for at in range(0, len(nodes), 2):
            run = nodes[at : at + 2]
            for side, other in ((0, 1), (1, 0)):
                for k in groups[at + side] if side < len(run) else []:
                    steps[k].append(("LR"[side == 0], run[other]) if len(run) == 2 else ("", ""))
            above.append(digest("".join(run)))
            merged.append([k for group in groups[at : at + 2] for k in group])
        nodes, groups = above, merged
    return nodes[0], steps


def brute_manifest(rows):
    def leaf(row, more=0):
        doc_id, text, lang, source, n_chars = row
        n_chars = None if n_chars is None else n_chars + more
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    trees = {}
    for row in rows:
        more = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
        trees.setdefault(row[2], []).append(((row[0] is not None, row[0] or 0), leaf(row), leaf(row, more)))
    names = sorted(trees, key=lambda name: (name is not None, (name or "").encode()))
    held = [(sorted(trees[name]), climb([x[1] for x in sorted(trees[name])])) for name in names]
    if not held:
        return []
    root, top = climb([subroot for _, (subroot, _) in held])
    out = []
    for (leaves, (subroot, steps)), above in zip(held, top, strict=True):
        for ((known, doc_id), own, changed), path in zip(leaves, steps, strict=True):
            node = changed
            for side, sibling in path + above:
                node = digest(sibling + node if side == "L" else node + sibling)
            proof = digest("".join(sibling for _, sibling in path + above))
            out.append((doc_id if known else None, own, subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def documents(count):
    rng = random.Random(4)
    rows = [(k, f"text {k}", rng.choice(["de", "en", "en", "en", None, "fr"]), "s", k) for k in range(count)]
    odd = [(None, "a", None, "s", 1), (5, None, None, None, None), (5, None, None, None, None), (9, "", "lone", "é", None)]
    return rows + odd + [(11, "long " * 100_000, "en", None, 500_000), (2**62, "x", "日本", "s", 2**63 - 1)] if count else []


@pytest.mark.parametrize("levels", [merkle.LEVELS, 2])
@pytest.mark.parametrize("count", [300, 1, 0])
def test_manifest_equals_brute_force(spark, count, levels):
    rows = documents(count)
    if count:
        rows[-1] = (2**62, "x", "日本", "s", 7)
    frame = spark.createDataFrame([(*row, "x", "y", 1) for row in rows], DOCS)
    one_more = F.when(fold("doc_id", 7) == 0, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))
    found = merkle.manifest(frame, changed={"n_chars": one_more}, levels=levels)
    steps = F.col("steps")
    folded = found.withColumn("folded", merkle.fold(F.col("changed_leaf"), steps))
    rows_found = folded.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(steps), "folded", F.expr("folded = root"))
    assert sorted((tuple(r) for r in rows_found.collect()), key=str) == brute_manifest(rows)


def test_witnesses_grow_as_nodes_are_appended():
    tree, digests = merkle.Appending(), [digest(str(k)).encode() for k in range(11)]
    for count, node in enumerate(digests, 1):
        tree.append(node)
        # Open subtrees are those of the binary digits of the count; a witness is as long as its subtree is high.
        heights = [height for height, _, _ in tree.open]
        assert heights == [bit for bit in range(4, -1, -1) if count >> bit & 1]
        for (height, first, _), end in zip(tree.open, [f for _, f, _ in tree.open[1:]] + [count], strict=True):
            assert {len(steps) for steps in tree.steps[first:end]} == {height}
    root, steps = climb([d.decode() for d in digests])
    assert tree.close().decode() == root
    kinds = {merkle.LONE: "", merkle.LEFT: "L", merkle.RIGHT: "R"}
    assert [[(kinds[s[:1]], s[1:].hex() if s[:1] != merkle.LONE else "") for s in one] for one in tree.steps] == steps

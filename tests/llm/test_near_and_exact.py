"""SimHash, substrings, decontamination and components against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from panewise.llm import components, decontamination, simhash, substrings

WORDS = ["ka", "lo", "mi", "ne", "pu", "ra", "so", "ti", "vu", "ze"]


def prose(rng, count, vocabulary=400):
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) + str(rng.randrange(vocabulary)) for _ in range(count))


def closure(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(3)
    pairs = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)]
    pairs += [(300 + k, 300 + (k + 1) % 9) for k in range(9)] + [(400, 400)]
    rng.shuffle(pairs)
    found = dict(components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect())
    want = closure({n for p in pairs for n in p}, pairs)
    want.pop(400)  # a loop links nothing
    assert found == want
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def naive_fingerprint(text):
    words = re.findall(r"[^ \t-\r]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    runs = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, frame):
    rng = random.Random(5)
    rows = []
    for k in range(40):
        base = prose(rng, 120).split()
        rows.append((k, " ".join(base)))
        for c in range(rng.randrange(3)):
            base[rng.randrange(len(base))] = "changed"
            rows.append((1000 + 3 * k + c, "\t".join(base)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "ONE two")]
    docs = frame(rows)
    prints = {i: naive_fingerprint(t) for i, t in rows}
    close = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    want = closure(prints, close)
    found = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert found == {i: (prints[i], want[i]) for i in prints}
    kept = {r["doc_id"] for r in simhash.one_of_each(docs).collect()}
    assert kept == set(want.values())


@pytest.mark.parametrize("part", [4, 1024])
def test_links_find_every_pair_within_the_distance(spark, part):
    rng = random.Random(8)
    values = set()
    for _ in range(12):
        center = rng.getrandbits(64)
        for _ in range(12):
            near = center
            for bit in rng.sample(range(64), rng.randrange(6)):
                near ^= 1 << bit
            values.add(near)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    pairs = simhash.links(spark.createDataFrame(signed, "fp bigint"), part=part).collect()
    nodes = [v for (v,) in signed]
    apart = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
    assert all(apart(a, b) <= 4 for a, b in pairs)
    brute = [(a, b) for a in nodes for b in nodes if a < b and apart(a, b) <= 4]
    assert closure(nodes, pairs) == closure(nodes, brute)


def test_simhash_of_odd_rows(odd):
    found = {(r["doc_id"], r["fp"]): r["component_id"] for r in simhash.near_duplicates(odd).collect()}
    assert simhash.near_duplicates(odd).count() == 6
    assert found[1, 0] == found[2, 0] == 1
    assert [c for (i, _), c in found.items() if i is None] == [None]
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    assert sorted(r["doc_id"] or 0 for r in simhash.one_of_each(odd).collect()) == [0, 1, 3, 3, 4]


def brute_removed(rows, length):
    split = {i: re.findall(r"[^ \t-\r]+", t or "") for i, t in rows}
    first = {}
    for i in sorted(split):
        for k in range(len(split[i]) - length + 1):
            first.setdefault(tuple(split[i][k : k + length]), i)
    out = {}
    for i, words in split.items():
        gone = [False] * len(words)
        for k in range(len(words) - length + 1):
            if first[tuple(words[k : k + length])] < i:
                gone[k : k + length] = [True] * length
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out[i] = (len(words), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize(("shard", "crowded"), [(2, 64), (4096, 64), (4096, 1), (2, 2)])
def test_substrings_equal_brute_force(frame, shard, crowded):
    rng = random.Random(11)
    passages = [prose(rng, 80) for _ in range(4)] + ["la " * 70]
    rows = []
    for k in range(60):
        parts = [prose(rng, rng.randrange(1, 60))]
        for _ in range(rng.randrange(3)):
            words = rng.choice(passages).split()
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = f"edit{rng.randrange(3)}"
            parts += [" ".join(words), prose(rng, rng.randrange(30))]
        rows.append((k * 7 % 61, " ".join(parts)))
    rows += [(100, rows[0][1]), (101, rows[3][1].replace(" ", "\n", 5)), (102, None), (103, "")]
    found = substrings.without_repeats(frame(rows), shard=shard, crowded=crowded).withColumn("sha", F.sha2("kept_text", 256))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["sha"]) for r in found.collect()}
    assert got == brute_removed(rows, 50)
    assert sum(v[1] for v in got.values()) > 1000


def test_a_short_notice_in_many_texts_sends_nothing_to_automata(frame, monkeypatch):
    rng, sent = random.Random(5), []
    notice, passage = prose(rng, 45), prose(rng, 60)
    rows = [(k, f"{prose(rng, 60)} {notice} {prose(rng, 60)}") for k in range(400)]
    rows += [(1000 + k, f"{prose(rng, 20)} {passage} {prose(rng, 20)}") for k in range(200)]
    matched = substrings._matched
    monkeypatch.setattr(substrings, "_matched", lambda bodies, *rest: sent.append(bodies.count()) or matched(bodies, *rest))
    found = {r["doc_id"]: r["n_removed"] for r in substrings.without_repeats(frame(rows)).collect()}
    assert found == {i: v[1] for i, v in brute_removed(rows, 50).items()}
    assert all((n >= 60) == (i > 1000) and (n == 0) == (i <= 1000) for i, n in found.items())
    assert sent[0] < 100


def test_substrings_of_odd_rows(odd):
    found = substrings.without_repeats(odd).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in found) == [
        (0, 3, 0), (1, 0, 0), (2, 0, 0), (3, 3, 0), (3, 3, 0), (4, 30_000, 0),
    ]
    assert substrings.without_repeats(odd.limit(0)).count() == 0


def test_automaton_finds_least_label_of_every_window():
    rng = random.Random(2)
    texts = [[rng.choice([b"a", b"b"]) for _ in range(30)] for _ in range(12)]
    automaton = substrings.Automaton()
    for text in texts[:8]:
        automaton.add(text)
    for label, text in enumerate(texts[:8]):
        automaton.name(text, label)
    automaton.spread()
    for text in texts:
        for length in (1, 4, 7):
            want = []
            for k in range(len(text) - length + 1):
                run = text[k : k + length]
                held = [n for n, t in enumerate(texts[:8]) if any(t[j : j + length] == run for j in range(31 - length))]
                want.append(min(held, default=None))
            assert automaton.least(text, length) == want


def naive_contamination(docs, items, size):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    out = {}
    for i, text in docs:
        words, hit, ids = cut(text), set(), set()
        for item, body in items:
            own = cut(body)
            runs = [own[k : k + size] for k in range(max(1, len(own) - size + 1))] if own else []
            for run in runs:
                for k in range(len(words) - len(run) + 1):
                    if words[k : k + len(run)] == run:
                        hit |= set(range(k, k + len(run)))
                        ids.add(str(item))
        out[i] = (len(words), len(hit), sorted(ids))
    return out


@pytest.mark.parametrize("block", [3, 1 << 18])
def test_decontamination_equals_brute_force(spark, frame, block):
    rng = random.Random(4)
    items = [(k, prose(rng, rng.choice([3, 9, 10, 25]), 30)) for k in range(12)] + [(20, None), (21, "..."), (2, "Ä 1b"), (2, "Ä 1b")]
    docs = [(k, prose(rng, 40, 30)) for k in range(15)]
    docs += [(50 + k, f"{prose(rng, 8, 30)} {body.upper()}! {body}") for k, (_, body) in enumerate(items[:10])]
    docs += [(90, "so ä 1B end ä,1b"), (91, None), (92, "")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.contamination(frame(docs), benchmark, block=block).collect()
    want = naive_contamination(docs, items, 10)
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"]) for r in found} == want
    clean = {r["doc_id"] for r in decontamination.decontaminate(frame(docs), benchmark, block=block).collect()}
    assert clean == {i for i, (_, hit, _) in want.items() if not hit}


def test_decontamination_of_odd_rows(spark, odd):
    benchmark = spark.createDataFrame([(None, "a b c"), (1, "same same"), (2, "a b")], "item_id bigint, text string")
    found = decontamination.contamination(odd, benchmark).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["item_ids"]) for r in found) == [
        (0, 3, 2, ["2"]), (1, 0, 0, []), (2, 0, 0, []), (3, 3, 3, ["1"]), (3, 3, 3, ["1"]), (4, 30_000, 0, []),
    ]
    assert decontamination.contamination(odd.limit(0), benchmark).count() == 0
    assert {r["n_hit"] for r in decontamination.contamination(odd, benchmark.limit(0)).collect()} == {0}


def test_decontamination_runs_no_python(spark, odd):
    benchmark = spark.createDataFrame([(1, "same same")], "item_id bigint, text string")
    plan = decontamination.contamination(odd.limit(1), benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_forest_spans_what_is_linked():
    values = np.array([0, 1, 3, 7, 0xFF << 40], dtype=np.uint64)
    # Both sides hold all five: two trees, of eight nodes and of two.
    assert len(simhash.forest(values, values, 4)) == 8

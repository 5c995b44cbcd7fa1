"""Prefix tries, decontamination and hard negatives against loops."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import edge
import numpy as np
import pytest
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from loadtrail.llm import decontamination, hard_negatives, prefix_trie
from loadtrail.llm.prefix_trie import DoubleArray

CLASH = (
    "seq path class n p mark cut depth upper conv chars ends first ids row hits start length print key item new id keys "
    "set_key part kind number vec rid rids labels low high home slot score place last hilbert found_rid"
).split()


def frame(spark, fields, rows):
    taken = {f.name for f in fields}
    extra = [StructField(x, StringType()) for x in CLASH if x not in taken]
    return spark.createDataFrame([(*r, *["clash"] * len(extra)) for r in rows], StructType([*fields, *extra]))


# prefix trie

TURNS = [StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()), StructField("text", StringType())]


def trie_loop(rows, rebuild=True):
    """The nodes, by the rules, from every prefix of every conversation."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1]))] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        whole[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1]) if path else 0
    found = []
    for path, convs in members.items():
        ended = ",".join(map(str, sorted(c for c in convs if whole[c] == path)))
        parent = min(members[path[:-1]]) if path else None
        sha = hashlib.sha256(ended.encode()).hexdigest()
        found.append((min(convs), len(path), parent, len(convs), children[path], leaves[path], saved[path], sha))
    return sorted(found, key=str)


def conversations(seed, convs=260, alphabet=4):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        if rng.random() < 0.1:
            continue
        base = [("user", "hello"), ("assistant", "yes?")] if rng.random() < 0.6 else []
        base += [(rng.choice(["user", None, ""]), rng.choice(["a", "bé", "", None, "😀x"][: alphabet + 1])) for _ in range(rng.randrange(6))]
        rows += [(c, k, *turn) for k, turn in enumerate(base)]
    rows += [(300 + k, None if k % 2 else 0, "user", "copy") for k in range(40)]
    rows += [(77, 100 + k, "user", f"turn {k % 9}") for k in range(300)]
    rows += [(78, 100 + k, "user", f"turn {k % 9}") for k in range(290)]
    rows += [(None, 1, "user", "nobody"), (500, 3, None, None), (500, None, "r", "first"), (-5, 1, "a", "b")]
    rng.shuffle(rows)
    return rows


def nodes(found):
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("limits", [{}, {"prefix_turns": 5, "shard_turns": 50}, {"prefix_turns": 60}])
def test_trie_equals_loop(spark, limits):
    rows = conversations(3)
    found = prefix_trie.prefix_nodes(frame(spark, TURNS, rows), **limits)
    assert found.columns == "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert nodes(found) == trie_loop(rows)


def test_trie_of_conversations_as_they_are(spark):
    rows = conversations(4, convs=80)
    assert nodes(prefix_trie.prefix_nodes(frame(spark, TURNS, rows), rebuild=False, prefix_turns=20)) == trie_loop(rows, False)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert prefix_trie.prefix_nodes(frame(spark, TURNS, [])).count() == 0
    short = [c for c in range(1, 90) if zlib.crc32(str(c).encode()) % 6 > 1][:5]  # all own turns go, no first conversation
    rows = [(c, 0, "user", "x") for c in short]
    assert nodes(prefix_trie.prefix_nodes(frame(spark, TURNS, rows))) == trie_loop(rows)


def test_hot_prefixes_are_dealt_out(spark):
    rows = [(c, k, "user", "same" if k < 3 else f"{c}") for c in range(200) for k in range(5)]
    sequences = prefix_trie.sequences_of(frame(spark, TURNS, rows), "conv_id", "turn", "role", "text")
    classes = sequences.selectExpr("seq", "conv_id AS class", "1L AS n")
    cuts = {r["cut"] for r in prefix_trie.with_cuts(classes, 100).collect()}
    assert cuts == {4}  # three turns are shared by all, so a prefix of four deals them out


def test_ids_of_one_end_are_hashed_in_pieces(spark):
    rows = [(c, 0, "user", "same") for c in range(100, 5_000, 100)]  # firsts of their blocks: nothing is replaced
    found = prefix_trie.prefix_nodes(frame(spark, TURNS, rows))
    assert nodes(found) == trie_loop(rows)


def test_double_array_holds_its_sequences():
    rng = np.random.default_rng(5)
    lengths = rng.integers(0, 12, 400)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    codes = rng.integers(0, 30, offsets[-1]) ** 2
    trie = DoubleArray(codes, offsets, 900)
    reached = {}
    for depth, going, state in trie.walk(codes, offsets):
        for s, node in zip(going, state):
            path = tuple(codes[offsets[s] : offsets[s] + depth])
            assert reached.setdefault(path, node) == node
    assert len(set(reached.values())) == len(reached)
    assert len(trie.check) < 4 * (len(reached) + 900)
    long = DoubleArray(np.zeros(5_000, int), np.array([0, 5_000]), 1)  # room does not grow with every level
    assert len(long.check) < 20_000


# decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = [StructField("doc_id", LongType()), StructField("text", StringType())]
ITEMS = [StructField("item_id", LongType()), StructField("text", StringType())]


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def contaminated(docs, items):
    found = []
    for doc, text in docs:
        w, hit, met = words(text), set(), set()
        for item, passage in items:
            p = words(passage)
            m = min(len(p), 10)
            for i in range(len(p) - m + 1 if m else 0):
                for j in range(len(w) - m + 1):
                    if w[j : j + m] == p[i : i + m]:
                        hit.update(range(j, j + m))
                        met.add("null" if item is None else str(item))
        found.append((doc, len(w), len(hit), len(met), sorted(met)))
    return sorted(found, key=str)


def passages(seed):
    rng = random.Random(seed)
    made = lambda n: " ".join(rng.choice(["The", "çà", "x9", "Y", "über", "end."]) for _ in range(n))
    items = [(k, made(rng.randrange(11, 40))) for k in range(12)]
    items += [(50, "Rare phrase"), (51, "unique"), (52, ""), (53, None), (54, "- !"), (None, "four words without id"), (50, "other of fifty")]
    docs = [(k, made(rng.randrange(60))) for k in range(40)]
    docs += [(100 + k, f"{made(30)} {rng.choice(items)[1] or ''}, {made(rng.randrange(30))}") for k in range(60)]
    docs += [(200, None), (201, ""), (201, "a rare PHRASE, unique"), (None, "Four, words: without ID?"), (202, "tail " * 500 + items[0][1])]
    docs += [(203, items[3][1])] * 3 + [(204, "other of fifty unique")]
    return docs, items


@pytest.mark.parametrize("piece", [100, 1 << 20])
def test_contamination_equals_loop(spark, piece):
    docs, items = passages(7)
    found = decontamination.contamination(frame(spark, DOCS, docs), frame(spark, ITEMS, items), piece_bytes=piece)
    assert sorted((tuple(r) for r in found.collect()), key=str) == contaminated(docs, items)


def test_contamination_of_nothing(spark):
    docs, items = frame(spark, DOCS, [(1, "some text"), (2, None)]), frame(spark, ITEMS, [])
    found = sorted(map(tuple, decontamination.contamination_digest(docs, items).collect()))
    assert found == [(k, n, 0, 0, hashlib.sha256(b"").hexdigest(), False) for k, n in ((1, 2), (2, 0))]
    assert decontamination.contamination(frame(spark, DOCS, []), frame(spark, ITEMS, [(1, "a")])).count() == 0
    assert decontamination.contamination(edge.frame(spark), frame(spark, ITEMS, [(1, edge.PROSE)])).where("n_hit > 0").count() > 10


def test_shared_windows_keep_the_same_fingerprint():
    rng = random.Random(2)
    text = [rng.choice("abcdefgh") for _ in range(600)]
    for _ in range(50):
        at = rng.randrange(580)
        shared = " ".join(text[at : at + 10])
        left, right = (" ".join(rng.choice("xyz") for _ in range(rng.randrange(20))) for _ in range(2))
        ours = decontamination.Words(f"{left} {shared} {right}".encode())
        starts, prints = decontamination.windows(ours, 10, 10, None)
        other = decontamination.windows(decontamination.Words(shared.encode()), 10, 10, None)
        assert other[1][0] in prints[starts == len(left.split())]
    assert len(set(decontamination.winnowed(ours.grams(5), 6))) < 0.5 * len(ours)


# hard negatives

VECTORS = [StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType())), StructField("label", IntegerType())]


def negatives_loop(rows):
    known = []
    for own_id, vector, label in rows:
        if own_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        known.append((own_id, [math.floor(256 * x) for x in vector], (label + 1) % 10 if own_id % 7 == 0 else label))
    found = []
    for a, (own_id, vector, label) in enumerate(known):
        if own_id % 50:
            continue
        scores = [(-sum(x * y for x, y in zip(vector, v)), i, k) for k, (i, v, _) in enumerate(known) if k != a]
        same = sorted(s for s in scores if known[s[2]][2] == label)[:5]
        for positive, positive_id, _ in same:
            fit = sorted(s for s in scores if known[s[2]][2] != label and -50 * positive <= -100 * s[0] <= -95 * positive)
            found += [(own_id, positive_id, r + 1, i, -positive, -s) for r, (s, i, _) in enumerate(fit[:3])]
    return sorted(found)


def vectors(seed, n=700, size=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    rows = []
    for k in range(n):
        c = int(rng.integers(6))
        rows.append((k, (centres[c] + 0.4 * rng.normal(size=size)).tolist(), int(rng.integers(3)) if rng.random() < 0.2 else c))
    rows += [(1_000 + k, centres[0].tolist(), k % 2) for k in range(60)]  # ties
    rows += [(350, centres[1].tolist(), 2), (350, centres[1].tolist(), 2), (701, [], 1), (750, [], 1), (702, [0.5], 2)]
    rows += [(None, centres[0].tolist(), 1), (800, None, 1), (801, [math.nan] * size, 1), (802, [None] * size, 1)]
    rows += [(850, [math.inf] * size, 1), (803, centres[2].tolist(), None), (900, (-centres[2]).tolist(), 9)]
    return rows


@pytest.mark.parametrize("shape", [{}, {"part_rows": 60, "block_rows": 7}])
def test_hard_negatives_equal_loop(spark, shape):
    rows = vectors(3)
    found = hard_negatives.hard_negatives(frame(spark, VECTORS, rows), **shape)
    assert found.columns == "anchor_id positive_id rank negative_id positive_score negative_score".split()
    assert sorted(map(tuple, found.collect())) == negatives_loop(rows)


@pytest.mark.parametrize("rows", [[], [(50, [], 1), (100, [], 1)], [(50, [1.0], 1)], [(0, None, 1)], [(50, [0.0], 3), (51, [1.0], 3), (52, [0.0], 4)]])
def test_hard_negatives_of_little(spark, rows):
    assert sorted(map(tuple, hard_negatives.hard_negatives(frame(spark, VECTORS, rows)).collect())) == negatives_loop(rows)


def test_neighbours_on_the_curve_are_neighbours():
    for n, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), axis=-1).reshape(-1, n)
        keys = hard_negatives.hilbert_keys(grid, bits)
        assert len(set(keys)) == len(grid)
        path = grid[sorted(range(len(grid)), key=keys.__getitem__)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_spare_blocks():
    rng = np.random.default_rng(1)
    centres = rng.integers(-200, 200, (8, 16))
    groups = [centres[k] + rng.integers(-9, 10, (50, 16)) for k in range(8)]
    boxes = hard_negatives.Zones(*(np.array([f(g, axis=0) for g in groups]) for f in (np.min, np.max)))
    anchors = np.array([g[0] for g in groups])
    least, most = boxes.bounds(anchors)
    for b, g in enumerate(groups):
        scores = anchors @ g.T
        assert (least[:, b] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= most[:, b]).all()
    own = np.array([(a @ groups[k].T).min() for k, a in enumerate(anchors)])[:, None]
    reached = hard_negatives.reaching(least, most, own, np.full_like(own, hard_negatives.HIGHEST))
    assert reached.diagonal().all() and reached.sum() < 24

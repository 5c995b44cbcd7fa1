"""Exact deduplication, the n-gram join and span removal against loops."""

import hashlib

import duckdb
import edge
import loops
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loadtrail.llm import exact_dedup, ngram_join, substring_dedup
from loadtrail.llm.components import components
from loadtrail.llm.oracle import oracle_sql
from loadtrail.llm.queries import queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    wanted = con.sql(oracle_sql()[name])
    found = queries()[name](spark, SMALL).select(wanted.columns).collect()
    assert sorted(map(tuple, found), key=str) == sorted(wanted.fetchall(), key=str)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_duplicates(spark, keep):
    rows = edge.texts()
    found = exact_dedup.exact_duplicates(edge.frame(spark), keep=keep).collect()
    assert len(found) == len(rows)
    groups = {}
    for d, t in rows:
        groups.setdefault(loops.lowered(t), []).append(d)
    wanted = []
    for d, t in rows:
        own = groups[loops.lowered(t)]
        known = [x for x in own if x is not None]
        keeper = (min if keep == "smallest" else max)(known) if known else None
        wanted.append((d, keeper, len(own), d == keeper, hashlib.sha256(loops.lowered(t).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))


def test_drop_exact_duplicates_keeps_one_row_with_all_columns(spark):
    kept = exact_dedup.drop_exact_duplicates(edge.frame(spark))
    assert kept.columns == edge.frame(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    wanted = {}
    for d, t in edge.texts():
        wanted.setdefault(loops.lowered(t), []).append(d)
    smallest = [min((x for x in own if x is not None), default=None) for own in wanted.values()]
    assert sorted(map(str, ids)) == sorted(map(str, smallest))
    repeated = edge.frame(spark, [(1, "a"), (1, "a"), (1, "A"), (2, "b"), (2, "b")])
    assert sorted(r["doc_id"] for r in exact_dedup.drop_exact_duplicates(repeated).collect()) == [1, 2]


@pytest.mark.parametrize("budget", [1, 40, 10_000])
def test_trie_equals_a_dictionary_whatever_spills(budget):
    trie, wanted = exact_dedup.PatriciaTrie(budget), {}
    keys = [b"", b"a", b"ab", b"abc", b"abd", b"b" * 50, b"b" * 49 + b"c", b"ab", b"xyz"] + [bytes([k % 7, k % 5, k]) for k in range(90)]
    for n, key in enumerate(keys + keys[::3]):
        entry = (None if n % 11 == 0 else n, 1, 1)
        trie.insert(key, entry)
        wanted[key] = exact_dedup.merged(wanted.get(key), entry)
    found = list(trie.items())
    assert len(found) == len(wanted) and dict(found) == wanted


def test_trie_of_an_owner_branches_and_spills_subtrees(spark):
    exact_dedup.on_workers(spark)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    owned = exact_dedup.owned_texts(docs, "doc_id", "text", "smallest", exact_dedup.ascii_lower)
    parts = {}
    for text, *entry, part in owned.withColumn("part", F.spark_partition_id()).collect():
        parts.setdefault(part, []).append((bytes(text), tuple(entry)))
    rows = max(parts.values(), key=len)
    whole = exact_dedup.PatriciaTrie()
    for text, entry in rows:
        whole.insert(text, entry)
    inner = [n for n in exact_dedup.nodes(whole.root) if n.children and n.label]
    assert len(inner) > 3 and sum(len(n.label) for n in exact_dedup.nodes(whole.root)) < sum(len(t) for t, _ in rows)
    assert whole.held == sum(map(exact_dedup.node_weight, exact_dedup.nodes(whole.root))) - exact_dedup.NODE_BYTES
    budget, longest = whole.held // 4, max(len(t) for t, _ in rows)
    small, most = exact_dedup.PatriciaTrie(budget), 0
    for text, entry in rows + rows[::2]:
        small.insert(text, entry)
        most = max(most, small.held)
    assert any(n.places for n in exact_dedup.nodes(small.root))
    assert most <= budget + longest + 2 * exact_dedup.NODE_BYTES
    twice = {t for t, _ in rows[::2]}
    wanted = {t: exact_dedup.merged(e, e) if t in twice else e for t, e in rows}
    found = list(small.items())
    assert len(found) == len(wanted) and dict(found) == wanted


def test_map_task_sends_subtrees_on(monkeypatch):
    monkeypatch.setattr(exact_dedup, "TRIE_BYTES", 4000)
    texts = [b"%d" % (k * k % 97) * (k % 13) for k in range(500)]
    rows = [row for batch in exact_dedup.combine(iter([pa.record_batch({"t": texts, "o": range(500)})])) for row in batch.to_pylist()]
    counts = {}
    for r in rows:
        counts[r["content"]] = counts.get(r["content"], 0) + r["n_rows"]
        assert r["n_bytes"] == len(r["content"])
    assert counts == {t: texts.count(t) for t in texts}
    assert len(counts) < len(rows) < 500


def test_spilling_stands_prefixes_of_prefixes_and_long_shared_parts():
    keys = [b"a" * n for n in range(300)] + [b"x" * 5000 + bytes([k]) * (k % 3) for k in range(200)]
    trie, wanted = exact_dedup.PatriciaTrie(3000), {}
    for n, key in enumerate(keys + keys):
        trie.insert(key, (n, 1, 1))
        wanted[key] = exact_dedup.merged(wanted.get(key), (n, 1, 1))
    found = list(trie.items())
    assert len(found) == len(wanted) and dict(found) == wanted


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_similar_components(spark, words, percent):
    rows = [r for r in edge.texts() if r[0] != 3] + [(3, edge.PROSE * 3)]
    found = {r[0]: (r[1], r[2]) for r in ngram_join.similar_components(edge.frame(spark, rows), words, percent).collect() if r[0] is not None}
    assert found == loops.components(edge.by_id(rows), words, percent)


def test_similar_components_without_identifier_or_rows(spark):
    found = ngram_join.similar_components(edge.frame(spark)).where("doc_id IS NULL").collect()
    assert sorted((r["n_shingles"], r["component_id"]) for r in found) == [(1, None), (len(loops.shingles(edge.PROSE * 3, 3)), None)]
    assert ngram_join.similar_components(edge.nothing(spark)).count() == 0


def test_large_groups_are_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP_SHINGLES", 200)
    rows = [(k, edge.near(edge.PROSE * 4, 5 * k)) for k in range(30)] + [(50 + k, edge.near(edge.OTHER, k)) for k in range(9)]
    found = {r[0]: (r[1], r[2]) for r in ngram_join.similar_components(edge.frame(spark, rows), 3, 90).collect()}
    assert found == loops.components(dict(rows), 3, 90)


def counted(spark, rows, words, percent):
    found = ngram_join.similar_components(edge.frame(spark, rows), words, percent, count_links=True)
    return sorted(((r["doc_id"], r["n_links"]) for r in found.collect()), key=str)


@pytest.mark.parametrize("group", [200, 2_000_000])
def test_links_are_counted_once_in_one_group_and_in_blocks(spark, monkeypatch, group):
    monkeypatch.setattr(ngram_join, "GROUP_SHINGLES", group)
    rows = edge.texts() + [(100 + k, edge.near(edge.PROSE * 4, 5 * k)) for k in range(30)]
    rows += [(200 + k, edge.near(edge.PROSE * 4, 5 * (k % 3))) for k in range(12)]
    rows += [(300, edge.near(edge.PROSE * 4, 0)), (300, edge.near(edge.PROSE * 4, 15))]  # one identifier, two texts
    wanted = loops.link_counts(rows, 3, 90)
    assert max(n for _, n in wanted) > 12
    assert counted(spark, rows, 3, 90) == sorted(wanted, key=str)


def test_drop_similar_keeps_one_of_each_component(spark):
    rows = [r for r in edge.texts() if r[0] is not None]
    kept = ngram_join.drop_similar(edge.frame(spark, rows))
    assert kept.columns == edge.frame(spark).columns
    roots = {root for _, root in loops.components(dict(rows), 5, 80).values()}
    assert {r["doc_id"] for r in kept.collect()} == roots


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 90), (90, 95), (7, 7), (200, 201), (201, 200)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 1 for k in range(2, 41)}, 95: 90, 100: 90, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_without_repeated_spans(spark):
    rows = [r for r in edge.texts() if r[0] is not None]
    found = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeated_spans(edge.frame(spark, rows)).collect()}
    assert found == loops.without_repeats(dict(rows), 2, 20)
    assert found[6].strip() and len(found[6]) < len(dict(rows)[6])
    assert substring_dedup.without_repeated_spans(edge.nothing(spark)).count() == 0
    nulls = substring_dedup.without_repeated_spans(edge.frame(spark)).where("doc_id IS NULL").collect()
    assert sorted(r["text"] for r in nulls)[1] == "no identifier here"


def test_a_lone_passage_between_other_neighbours(spark):
    lone = " ".join(f"tall{k}" for k in range(60)) + "."
    bare = " ".join(f"wide{k} road{k * k}" for k in range(60))
    chinese = "".join(chr(0x4E00 + 37 * k) for k in range(50)) + "\u3002"
    thai = "".join(chr(0x0E01 + (k * k * 7 + k // 5) % 46) for k in range(160))
    rows = []
    for d in (1, 2):
        own = lambda n, d=d: " ".join(f"own{d}x{n}y{k}" for k in range(9))
        rows.append((d, f"{own(1)}. {lone} {own(2)}."))
        rows.append((10 + d, f"{own(3)} {bare} {own(4)}"))
        rows.append((20 + d, chr(0x5E00 + d) * 5 + "\u3002" + chinese + chr(0x5F00 + d) * 5 + "\u3002"))
        rows.append((30 + d, chr(0x0E40) * d + thai + chr(0x0E41) * d))
    text = dict(rows)
    docs = edge.frame(spark, rows)
    short = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeated_spans(docs).collect()}
    whole = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeated_spans(docs, run_words=40).collect()}
    for found in (short, whole):
        assert all(found[k] == text[k] for k in (1, 11, 21, 31))
        assert found[2] == text[2].replace(lone + " ", "") and found[22] == text[22].replace(chinese, "")
    assert short[12] == text[12]
    kept = whole[12].split()
    assert kept[:9] == text[12].split()[:9] and kept[-9:] == text[12].split()[-9:] and len(kept) < 18 + 60
    assert len(whole[32]) < len(text[32]) / 2


def test_pieces_are_the_sentence():
    for _, text in edge.texts():
        parts, begins = substring_dedup.cut(text or "", 40)
        assert "".join(parts) == (text or "") and len(begins) == len(substring_dedup.sentences(text or ""))


def test_sentences_are_the_text():
    for _, text in edge.texts():
        assert "".join(substring_dedup.sentences(text or "")) == (text or "")

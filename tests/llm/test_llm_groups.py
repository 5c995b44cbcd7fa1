"""Groups of the n-gram join: cut before shingles travel, and nothing that is linked falls apart."""

import edge
import loops
import numpy as np
import pytest

from loadtrail.llm import ngram_join


def chain_rows(n: int = 40) -> list[tuple[int, str]]:
    """Each text shares a rare passage with the next one and nothing else with any."""
    passage = [" ".join(f"pass{k}w{j}" for j in range(8)) for k in range(n + 1)]
    return [(k, f"{passage[k]} {' '.join(f'own{k}w{j}' for j in range(50))} {passage[k + 1]}") for k in range(n)]


def landed_rows(monkeypatch) -> dict:
    """What the join lands, by label."""
    kept, landed = {}, ngram_join.landed
    monkeypatch.setattr(ngram_join, "landed", lambda frame, label: kept.setdefault(label, landed(frame, label)))
    return kept


def test_chains_of_shared_passages_send_no_shingles(spark, monkeypatch):
    kept = landed_rows(monkeypatch)
    monkeypatch.setattr(ngram_join, "GROUP_SHINGLES", 200)
    rows = chain_rows() + [(100 + k, edge.near(edge.PROSE * 4, 5 * k)) for k in range(3)]
    found = {r[0]: (r[1], r[2]) for r in ngram_join.similar_components(edge.frame(spark, rows), 5, 80).collect()}
    assert found == loops.components(dict(rows), 5, 80)
    assert found[2][1] == 2 and found[102][1] == 100
    assert {r["doc_id"] for r in kept["dealt-candidates"].collect()} == {100, 101, 102}


@pytest.mark.parametrize(("docs", "shingles", "words", "percent"), [(4, 1 << 40, 5, 80), (1, 1, 3, 90), (1 << 40, 300, 1, 30)])
def test_large_groups_are_cut_in_cells_and_blocks(spark, monkeypatch, docs, shingles, words, percent):
    monkeypatch.setattr(ngram_join, "CELL_DOCS", docs)
    monkeypatch.setattr(ngram_join, "CELL_SHINGLES", shingles)
    rows = [r for r in edge.texts() if r[0] is not None and r[0] != 3] + [(3, edge.PROSE * 3)]
    rows = [(k, t) for k, (_, t) in enumerate(rows)] + [(100 + k, edge.near(edge.PROSE * 4, 5 * k)) for k in range(20)]
    rows += [(200 + k, " ".join((edge.PROSE * 4).split()[: 60 + 9 * k])) for k in range(9)] + [(300 + i, t) for i, t in chain_rows(12)]
    found = ngram_join.similar_components(edge.frame(spark, rows), words, percent, count_links=True).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == loops.components(dict(rows), words, percent)
    assert sorted((r["doc_id"], r["n_links"]) for r in found) == sorted(loops.link_counts(rows, words, percent))


@pytest.mark.parametrize("percent", [30, 50, 80, 90, 100])
def test_parities_leave_every_link(percent):
    draw = np.random.default_rng(percent)
    sets = [draw.integers(0, 1 << 63, n).astype(np.uint64) for n in (1, 2, 9, 60, 64, 65, 300, 2000)]
    for base in sets[:]:
        for share in (0.2, 0.5, 0.75, 0.9, 0.99):
            own = draw.integers(0, 1 << 63, draw.integers(0, 1 + len(base) // 5)).astype(np.uint64)
            sets.append(np.concatenate([base[: max(1, int(share * len(base)))], own]))
    sets = sorted(map(np.unique, sets), key=len)
    sizes = np.array([len(x) for x in sets])
    links = {
        (a, b)
        for a in range(len(sets))
        for b in range(a + 1, len(sets))
        if 100 * (both := len(np.intersect1d(sets[a], sets[b]))) >= percent * (sizes[a] + sizes[b] - both)
    }
    found = ngram_join.may_link(sizes, [ngram_join.parity_bits(x) for x in sets], percent, np.ones(len(sets), bool))
    roots = ngram_join.Roots(len(sets))
    for a, b in found:
        roots.join(a, b)
    assert all(roots.of(a) == roots.of(b) for a, b in links) and (links or percent == 100)
    assert len({roots.of(k) for k in range(len(sets))}) > 4

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm import odd

from wordtrawl.llm import jaccard_join, neighbours

VECTORS = "vec_id bigint, embedding array<double>, label int, rep int, vec int, shard int"


def brute(rows, k):
    """{query: [(id, score)]} over valid rows, ties to the smaller id."""
    valid = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    valid = [(i, v) for i, v in valid if np.isfinite(v).all() and v.any()]
    usual = Counter(len(v) for _, v in valid).most_common(1)[0][0] if valid else 0
    valid = [(i, v) for i, v in valid if len(v) == usual]
    out = {}
    for q, v in valid:
        if q % 50 == 0:
            found = {(i, round(float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), 9)) for i, w in valid if i != q}
            out[q] = sorted(found, key=lambda x: (-x[1], x[0]))[:k]
    return out


def answers(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
        assert r["rank"] == len(out[r.query_id])
    return out


def table(spark, rows):
    rows = [(i, v and [None if x is None else float(x) for x in v], 0, 0, 0, 0) for i, v in rows]
    return spark.createDataFrame(rows, VECTORS).repartition(3)


def test_neighbours_equal_brute_force_on_odd_vectors(spark):
    r = random.Random(1)
    rows = [(i, [round(r.gauss(0, 1), 3) for _ in range(6)]) for i in range(120)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)] + [(2000 + i, rows[7][1]) for i in range(9)]
    rows += [(150, None), (200, []), (250, [0.0] * 6), (300, [1.0, None, 0, 0, 0, 0]), (350, [float("nan")] * 6)]
    rows += [(400, [float("inf")] + [1.0] * 5), (450, [1.0, 2.0]), (None, [1.0] * 6), (500, [1e300] * 6), (550, [-0.0, 1.0, 0, 0, 0, 0])]
    rows.append(rows[3])
    got = answers(neighbours.nearest(table(spark, rows), F.col("id") % 50 == 0))
    rows[rows.index((500, [1e300] * 6))] = (500, [1.0] * 6)
    assert got == brute(rows, 5)


def test_few_or_no_vectors(spark):
    got = answers(neighbours.nearest(table(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0])]), F.col("id") % 50 == 0))
    assert got == {0: [(1, round(math.sqrt(0.5), 9))]}
    assert neighbours.nearest(table(spark, []), F.col("id") % 50 == 0).count() == 0


def test_recall_over_several_shards_and_blocks(spark, monkeypatch):
    r = np.random.default_rng(3)
    centres = r.normal(size=(30, 24))
    rows = [(i, [float(x) for x in centres[i % 30] + 0.6 * r.normal(size=24)]) for i in range(3000)]
    monkeypatch.setattr(neighbours, "build_index", lambda c, size=700: _BUILD(c, size))
    monkeypatch.setattr(neighbours, "search_index", lambda i, q, k: _SEARCH(i, q, k, block=16))
    got = answers(neighbours.nearest(table(spark, rows), F.col("id") % 50 == 0))
    want = brute(rows, 5)
    assert set(got) == set(want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.97


_BUILD, _SEARCH = neighbours.build_index, neighbours.search_index


def test_flat_arrays_give_the_graph_back():
    vectors = neighbours.unit(np.random.default_rng(2).normal(size=(400, 8)))
    graph = neighbours.Graph(vectors, 4).build(5, 20)
    again = neighbours.Graph.from_flat(vectors, graph.flat())
    assert all(graph.nearest(v) == again.nearest(v) for v in vectors[::20])


# Jaccard join ----------------------------------------------------------------------------------------------------------


def shingle_set(text):
    words = (text or "").lower().encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_join(rows):
    """[(id, class id, links)] by all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    ids = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            ids[root(a)] = min(i, ids.get(root(a), i))
    return sorted(((i, ids.get(root(a)), links[a]) for a, (i, _) in enumerate(rows)), key=repr)


def joined(spark, rows):
    frame = odd.documents(spark, [(i, t, "en") for i, t in rows])
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.join(frame).collect()), key=repr)


def changed(text, seed, n):
    r, words = random.Random(seed), text.split()
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.random()}"
    return " ".join(words)


def test_join_equals_all_pairs(spark):
    rows = [(i, odd.prose(i, 80)) for i in range(20)]
    rows += [(100 + i, changed(odd.prose(i % 5, 80), i, i % 4)) for i in range(60)]
    rows += [(200 + i, odd.prose(3, 80)) for i in range(30)] + [(300, odd.prose(3, 80).upper())]
    assert joined(spark, rows) == brute_join(rows)


def test_join_of_odd_documents(spark):
    rows = [(i, t) for i, t, _ in odd.ROWS] + [(20, "one two three"), (21, odd.LONG + " more"), (22, "one two three four")]
    assert joined(spark, rows) == brute_join(rows)
    assert jaccard_join.join(odd.empty(spark)).count() == 0


def test_large_groups_are_dealt_into_blocks(spark, monkeypatch):
    """Near copies of one text, many more than a block holds: every link is counted, no pair is returned."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "TASK_ROWS", 64)
    rows = [(i, changed(odd.prose(1, 120), i, 1 + i % 2)) for i in range(150)] + [(500 + i, odd.prose(1, 120)) for i in range(50)]
    assert joined(spark, rows) == brute_join(rows)


def test_passes_shorten_the_prefix_until_the_recall(spark, monkeypatch):
    """Pairs near the threshold are missed by whole labels at times; shorter prefixes, one minimum less each, find them."""
    depths = []
    whole = jaccard_join.matched
    monkeypatch.setattr(jaccard_join, "matched", lambda *a: depths.append(a[2]) or whole(*a))
    rows = [(i, odd.prose(i, 100)) for i in range(150)] + [(1000 + i, changed(odd.prose(i, 100), i, 2)) for i in range(150)]
    got, want = joined(spark, rows), brute_join(rows)
    assert len(depths) > 1 and depths == list(range(jaccard_join.DEPTH, depths[-1] - 1, -1))
    assert jaccard_join.found_share(0.8, depths[-1]) >= 0.998
    assert sum(links for *_, links in got) >= 0.999 * sum(links for *_, links in want)


def test_prefixes_are_shortened_without_any_found_link(spark, monkeypatch):
    """Texts without a single link: the recall asked for must hold for the hardest links there could be."""
    depths = []
    whole = jaccard_join.matched
    monkeypatch.setattr(jaccard_join, "matched", lambda *a: depths.append(a[2]) or whole(*a))
    rows = [(i, odd.prose(i, 60)) for i in range(10)]
    assert joined(spark, rows) == [(i, i, 0) for i in range(10)]
    assert jaccard_join.found_share(0.8, depths[-1]) >= jaccard_join.RECALL > jaccard_join.found_share(0.8, depths[-1] + 1)


def test_forest_is_sorted_and_knows_shared_prefixes(spark):
    """Every label that shares a prefix with another says so, at all lengths; none says more, but at the ends of a task."""
    r = np.random.default_rng(5)
    sigs = r.integers(0, 3, (200, jaccard_join.TREES * jaccard_join.DEPTH)).astype("<u4")
    nodes = spark.createDataFrame([(b"%03d" % i, s.tobytes()) for i, s in enumerate(sigs)], "node binary, sig binary")
    got = {(x.tree, x.node): x.shared for x in jaccard_join.forest(nodes).collect()}
    labels, more = sigs.reshape(200, jaccard_join.TREES, jaccard_join.DEPTH), 0
    for tree in range(jaccard_join.TREES):
        same = np.logical_and.accumulate(labels[:, None, tree] == labels[None, :, tree], axis=2).sum(axis=2)
        np.fill_diagonal(same, 0)
        for i, longest in enumerate(same.max(axis=1).tolist()):
            assert got.get((tree, b"%03d" % i), 0) >= longest
            more += got.get((tree, b"%03d" % i), 0) > longest
    assert more <= 2 * 4


def test_shared_prefixes_across_batches():
    """Rows come in batches of any size, an empty one and single rows among them."""
    r = np.random.default_rng(6)
    rows = sorted((int(r.integers(0, 2)), r.integers(0, 2, jaccard_join.DEPTH).astype("<u4").tobytes(), b"%d" % i) for i in range(60))
    table = pa.table({"tree": pa.array([x[0] for x in rows], pa.int32()), "label": [x[1] for x in rows], "node": [x[2] for x in rows]})
    cut = [0, 0, 1, 2, 17, 18, 60]
    for cuts in (cut, [0, 60], list(range(61))):
        batches = [b for a, z in zip(cuts, cuts[1:]) for b in (table.slice(a, z - a).to_batches() or [table.to_batches()[0].slice(0, 0)])]
        got = pa.Table.from_batches(list(jaccard_join.shared_prefixes(batches)))
        assert got.drop_columns(["shared"]).to_pylist() == table.to_pylist()

        def common(a, b):
            pairs = zip(*(np.frombuffer(x[1], "<u4") for x in (a, b)))
            return next((n for n, (x, y) in enumerate(pairs) if x != y), jaccard_join.DEPTH) if a[0] == b[0] else 0

        want = [max(common(rows[i], rows[i - 1]), common(rows[i], rows[i + 1])) for i in range(1, 59)]
        assert got.column("shared").to_pylist() == [jaccard_join.DEPTH, *want, jaccard_join.DEPTH]


@pytest.mark.parametrize("depth", [4, 6])
def test_found_share_is_that_of_a_forest(depth):
    r = np.random.default_rng(depth)
    hits = 0
    for _ in range(300):
        common, extra = r.integers(0, 2**63, 80), r.integers(0, 2**63, (2, 10))
        a, b = (jaccard_join.signature(np.append(common, e).astype(np.uint64)).reshape(16, 6) for e in extra)
        hits += (a[:, :depth] == b[:, :depth]).all(axis=1).any()
    assert abs(hits / 300 - jaccard_join.found_share(0.8, depth)) < 0.04


def test_dense_and_sparse_intersections_agree():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 400, r.integers(1, 200)).astype(np.uint64)) for _ in range(40)]
    every = ~np.eye(40, dtype=bool)
    dense = jaccard_join.intersections(sets, every)
    few = np.zeros((40, 40), bool)
    few[3, 9] = few[9, 3] = True
    assert all(dense[a, b] == len(np.intersect1d(sets[a], sets[b])) for a in range(40) for b in range(40) if a != b)
    assert jaccard_join.intersections(sets, few)[3, 9] == dense[3, 9]


def test_classes_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    r = random.Random(1)
    r.shuffle(edges)
    frame = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in edges], "u binary, v binary")
    got = {r.u[0]: r.v[0] for r in jaccard_join.classes(frame).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 130)} | {201: 200}

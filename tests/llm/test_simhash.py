import numpy as np
import xxhash
from helpers import documents, words

from querytrail.llm import simhash as S


def plain(text):
    w = words(text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, ids, most=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                parent[find(i)] = find(j)
    small = {}
    for i in range(len(fps)):
        if ids[i] is not None:
            small[find(i)] = min(ids[i], small.get(find(i), ids[i]))
    return [small.get(find(i)) for i in range(len(fps))]


def rows():
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for i in range(25):
        base = rng.choice(vocabulary, 150).tolist()
        out.append((100 + i, " ".join(base)))
        for k in range(i % 6):
            changed = list(base)
            changed[int(rng.integers(0, 150))] = "CHANGED"
            out.append((500 - 10 * i + k, "  ".join(changed).upper()))
    return out + [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "a " * 50_000), (100, out[0][1]), (None, out[0][1]), (None, "alone in the world here")]


def test_matches_brute_force(spark):
    data = rows()
    fps = [plain(t) for _, t in data]
    want = sorted(zip([str(i) for i, _ in data], [format(f, "016x") for f in fps], [str(c) for c in components(fps, [i for i, _ in data])], strict=True))
    got = S.simhash_components(documents(spark, data).repartition(5)).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want


def test_representatives_keep_one_row_each(spark):
    data = rows()
    docs = documents(spark, data)
    kept = S.representatives(docs)
    assert kept.columns == docs.columns
    fps = [plain(t) for _, t in data]
    groups = components(fps, [i if i is not None else 10**6 for i, _ in data])
    assert sorted(r["doc_id"] if r["doc_id"] is not None else 10**6 for r in kept.collect()) == sorted(set(groups))


def test_dense_group_gives_no_pairs_but_one_component():
    rng = np.random.default_rng(2)
    base = np.uint64(rng.integers(0, 1 << 63))
    fps = np.unique(base ^ np.array([sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for _ in range(3000)], np.uint64))
    cells = np.zeros(len(fps), np.int64)
    a, b = S.cell_links(cells, fps)
    assert len(a) < len(fps)
    assert len(set(components([int(x) for x in fps[:300]], list(range(300))))) == 1


def test_grid_meets_every_link():
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    for bits in range(5):
        other = fps ^ np.array([sum(1 << int(b) for b in rng.choice(64, bits, replace=False)) for _ in fps], np.uint64)
        a, b = S.grid_cells(fps), S.grid_cells(other)
        assert all(set(x[x >= 0]) & set(y[y >= 0]) for x, y in zip(a, b, strict=True))


def test_connected_long_chain_and_hub(spark):
    rng = np.random.default_rng(8)
    chain = rng.permutation(200).tolist()
    edges = list(zip(chain, chain[1:], strict=False)) + [(1000, 1001 + i) for i in range(50)] + [(7, 7)]
    got = dict(S.connected(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[i] for i in range(200)} == {0} and {got[1001 + i] for i in range(50)} == {1000}


def test_empty(spark):
    assert S.simhash_components(documents(spark, [])).count() == 0
    assert S.representatives(documents(spark, [])).count() == 0


def test_columns_of_any_name_stay(spark):
    names = ["none", "k", "h", "kept_none", "Kept_K", "kept_h", "_h", "fp", "root", "best", "node", "m"]
    rows = [(i, "a b c d e" if i else "x y z", *(10 * i + j for j in range(len(names)))) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} long" for n in names))
    got = S.representatives(docs)
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == rows[:2]

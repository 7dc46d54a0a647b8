import math

import numpy as np

from tabspark.llm import embed_dedup


def brute(rows, least=0.93):
    """Rows (id, vector, label) to (id, n_links, component_id, kept)."""
    able = [k for k, (i, v, lab) in enumerate(rows) if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    up, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    unit = {k: (x := np.array(rows[k][1], np.float64) / max(map(abs, rows[k][1]))) / np.linalg.norm(x) for k in able}
    for s, a in enumerate(able):
        for b in able[s + 1 :]:
            if rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
                links[a] += 1
                links[b] += 1
                up[find(a)] = find(b)
    low: dict = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    out = []
    for k, (i, _, _) in enumerate(rows):
        component = None if i is None else low[find(k)]
        out.append((i, links[k], component, i is None or component == i))
    return sorted(out, key=str)


def made(seed, labels=3, width=12):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(150):
        rows.append([k, rng.normal(size=width), int(rng.integers(labels))])
    for k in range(150, 260):  # near copies, in chains too
        i, v, lab = rows[rng.integers(len(rows))]
        rows.append([k, v + rng.normal(size=width) * rng.choice([0.05, 0.2, 0.4]) * np.linalg.norm(v) / math.sqrt(width), lab])
    out = [(int(k) * 3 % 1000, [float(np.float32(x)) for x in v], lab) for k, v, lab in rows]
    v = out[0][1]
    out += [(2000 + k, v, 0) for k in range(40)] + [(3000, v, 1), (3001, v, None), (None, v, 0), (None, None, None)]
    out += [(3002, None, 0), (3003, [], 0), (3004, [0.0] * width, 0), (3005, [float("nan")] + v[1:], 0), (3006, [float("inf")] + v[1:], 0)]
    out += [(3007, [None] + v[1:], 0), (3008, v[:-1], 0), (3009, v[:-1], 0), (3010, [2 * x for x in v], 0), (3011, [-x for x in v], 0)]
    out += [(3012, [1.0], 2), (3013, [5.0], 2), (3014, [-1.0], 2), out[10], out[10], (out[11][0], out[12][1], out[12][2]), (3015, [1e38] * width, 2), (3016, [1e-38] * width, 2)]
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_near_keeps_every_pair_and_stops_early():
    rng = np.random.default_rng(0)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    for n, width in ((40, 3), (60, 16), (60, 33)):
        a = unit(rng.normal(size=(n, width)))
        b = unit(np.concatenate([rng.normal(size=(n, width)), a[:10] + 0.02 * rng.normal(size=(10, width))]))
        for least in (0.3, 0.8, 0.93):
            for step in (1, 8, 64):
                i, j = embed_dedup.near(a, b, least, step)
                got = set(zip(*map(np.ndarray.tolist, embed_dedup.exact(a, b, i, j, least)), strict=True))
                assert got == set(zip(*map(np.ndarray.tolist, np.nonzero(np.einsum("ik,jk->ij", a, b) >= least)), strict=True))
    a = np.zeros((5, 64))
    a[:, 0] = 1
    b = np.zeros((5, 64))
    b[:, 1] = 1
    assert not len(embed_dedup.near(a, b, 0.93, 1)[0])


def test_groups_equal_brute_force(spark):
    for seed in (1, 2):
        data = made(seed)
        df = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in data], "vec_id long, embedding array<float>, label int, key string, tile int").repartition(5)
        want = brute(data)
        assert rows(embed_dedup.groups(df)) == want
        assert rows(embed_dedup.groups(df, tile=7)) == want  # cells of several tiles
        assert any(n > 1 and not kept for _, n, _, kept in want)


def test_hot_group_of_near_copies(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=64)
    data = [(k, [float(x) for x in base + 0.02 * rng.normal(size=64)], "a") for k in range(400)] + [(1000 + k, [float(x) for x in rng.normal(size=64)], "a") for k in range(200)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label string")
    got = rows(embed_dedup.groups(df, tile=50))
    assert got == brute(data)
    assert sum(n == 399 and c == 0 for _, n, c, _ in got) == 400


def test_string_ids_and_empty_table(spark):
    df = spark.createDataFrame([("b", [1.0, 0.0], "x"), ("a", [1.0, 0.1], "x"), ("c", [0.0, 1.0], "x")], "id string, v array<double>, kind string")
    got = rows(embed_dedup.groups(df, key="id", vector="v", label="kind"))
    assert got == [("a", 1, "a", True), ("b", 1, "a", False), ("c", 0, "c", True)]
    assert not embed_dedup.groups(df.limit(0), key="id", vector="v", label="kind").collect()

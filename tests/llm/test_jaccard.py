"""The pipeline's near-duplicates against all pairs of five-word shingle sets."""

import random

import corpus_pipeline as cp
from detlake.llm import jaccard
from tests.llm.test_llm import docs, words


def shingles(t):
    w = (t or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_against_all_pairs(spark):
    rnd = random.Random(1)
    rows = []
    for g in range(25):
        base = words(200, 3000 + g).split()
        rows.append((len(rows), " ".join(base)))
        for edits in (1, 2, 3, 4, 5, 8, 20):
            w = list(base)
            for at in rnd.sample(range(len(w)), edits):
                w[at] = f"new{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    base = words(300, 9).split()
    rows += [(len(rows) + i, " ".join([*base, f"end{i}"])) for i in range(60)]  # a long list
    rows += [(1000, None), (1001, ""), (1002, " . "), (1003, "one two"), (1004, "One  two")]
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and (sets[i] or sets[j]) and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    up[1001] = 1000  # equal texts
    d = docs(spark, rows)
    found = {}
    for r in jaccard.near_duplicates(d).collect():
        found.setdefault(r["root"], set()).add(r["doc_id"])
    want = {}
    for i in sets:
        want.setdefault(root(i), set()).add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))
    left = {r["doc_id"] for r in cp.drop_near_duplicates(spark, d, "").collect()}
    assert left == {min(x) for x in want.values()}


def test_divided_lists_are_compared_in_full(spark):
    """What neighbours in a list miss, the rest must find."""
    rnd = random.Random(8)
    shared = words(60, 77).split()
    rows = []
    for g in range(30):  # groups share a passage, members of a group nearly all
        own = words(60, 500 + g).split()
        for k in range(4):
            w = [*shared, *own]
            w[60 + rnd.randrange(60)] = f"x{g}{k}"
            rows.append((len(rows), " ".join(w)))
    d = docs(spark, rows)
    found = {}
    for r in jaccard.near_duplicates(d).collect():
        found.setdefault(r["root"], set()).add(r["doc_id"])
    assert sorted(map(sorted, found.values())) == [list(range(4 * g, 4 * g + 4)) for g in range(30)]
    texts = [jaccard.signature(jaccard.np.unique(jaccard.np.array(jaccard.text_hashes(t, 5), "u8"))) for _, t in rows]
    prints = spark.createDataFrame([(i, jaccard.bands(x).tolist(), bytearray((x >> jaccard.np.uint64(8)).astype("u1").tobytes())) for i, x in enumerate(texts)], "h long, keys array<long>, least binary")
    none = spark.createDataFrame([], "h long, root long")
    sure = {(r["a"], r["b"]) for r in jaccard.divided_lists(prints, none).collect()}
    assert sure and all(b - a < 4 and a // 4 == b // 4 for a, b in sure if (texts[a] == texts[b]).sum() >= 60)
    lists = {}
    for i, x in enumerate(texts):
        for band, key in enumerate(jaccard.bands(x).tolist()):
            lists.setdefault((band, key), []).append(i)
    want = {(a, b) for m in lists.values() if len(m) > 2 for a in m for b in m if a < b and ((texts[a] >> jaccard.np.uint64(8)).astype("u1") == (texts[b] >> jaccard.np.uint64(8)).astype("u1")).sum() >= jaccard.LIKELY}
    largest = {key: m for key, m in lists.items() if len(m) > 2}
    assert sure == want and largest


def near_group(n, seed=21):
    """Texts of 150 words that differ from a common one at two to five places: most pairs lie below the bound, all agree in lists."""
    rnd = random.Random(seed)
    base, rows = words(150, seed).split(), []
    for i in range(n):
        w = list(base)
        for at in rnd.sample(range(len(w)), rnd.choice((2, 3, 4, 5))):
            w[at] = f"new{i}x{at}"
        rows.append((i, " ".join(w)))
    return rows


def plain_groups(sets, tied=()):
    """The components of ``tied`` and of all pairs at the bound."""
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    near = [(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    for i, j in [*tied, *near]:
        up[root(i)] = root(j)
    groups = {}
    for i in sets:
        groups.setdefault(root(i), set()).add(i)
    return sorted(map(sorted, groups.values()))


def test_no_table_grows_with_the_square_of_a_near_group(spark, monkeypatch):
    rows, made, cut = near_group(240), {}, jaccard.cut

    def counted(df, name, *by):
        out = cut(df, name, *by)
        made[name] = max(made.get(name, 0), out.count())
        return out

    monkeypatch.setattr(jaccard, "cut", counted)
    found = {}
    for r in jaccard.near_duplicates(docs(spark, rows)).collect():
        found.setdefault(r["root"], set()).add(r["doc_id"])
    assert sorted(map(sorted, found.values())) == plain_groups({i: shingles(t) for i, t in rows})
    assert made["divided-lists"] and max(made.values()) <= jaccard.BANDS * len(rows), made


def test_blocks_of_a_list_find_what_the_whole_list_does(spark, monkeypatch):
    rows = near_group(90, 22)
    sets = {i: shingles(t) for i, t in rows}
    least = {i: jaccard.signature(jaccard.np.unique(jaccard.np.array(jaccard.text_hashes(t, 5), "u8"))) for i, t in rows}
    prints = spark.createDataFrame([(i, jaccard.bands(x).tolist()) for i, x in least.items()], "h long, keys array<long>")
    texts = spark.createDataFrame(rows, "h long, t string")
    for size, length, known in ((1024, 8 << 20, 0), (16, 8 << 20, 0), (16, 8 << 20, 40), (1024, 10_000, 40)):
        monkeypatch.setattr(jaccard, "BLOCK", size)
        monkeypatch.setattr(jaccard, "BLOCK_BYTES", length)
        tied = spark.createDataFrame([(i, 0) for i in range(known)], "h long, root long")
        found = [(r["a"], r["b"]) for r in jaccard.joining_links(prints, tied, texts, 5, 0.8).collect()]
        up = plain_groups(sets, [(0, i) for i in range(known)])
        assert all(len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for a, b in found)
        joined = plain_groups({i: {i} for i in sets}, [*found, *((0, i) for i in range(known))])
        assert joined == up, (size, length, known)


def test_join_groups_against_all_pairs():
    np, rnd = jaccard.np, random.Random(5)
    for trial in range(300):
        least = rnd.choice((0.5, 0.8, 0.9, 1.0))
        bases = [rnd.sample(range(400), rnd.choice((1, 2, 5, 20, 60))) for _ in range(3)]
        sets = []
        for _ in range(rnd.randrange(2, 30)):
            base = rnd.choice(bases)
            sets.append({*rnd.sample(base, max(1, len(base) - rnd.choice((0, 0, 1, 2, 8)))), *(rnd.randrange(400) for _ in range(rnd.choice((0, 0, 1, 3))))})
        group = np.array([rnd.randrange(len(sets)) for _ in sets])
        side = np.array([rnd.random() < 0.5 for _ in sets])
        probes, targets = (side, ~side) if trial % 2 else (side, np.ones(len(sets), bool))
        found = jaccard.join_groups([np.array(sorted(x), "u8") for x in sets], group, probes, targets, least)
        want = [(i, j) for i in np.flatnonzero(probes) for j in np.flatnonzero(targets) if group[i] != group[j] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]) - 1e-9]

        def parts(pairs, of=group):
            name = {g: g for g in of.tolist()}
            for i, j in pairs:
                a, b = name[of[i]], name[of[j]]
                name = {g: b if x == a else x for g, x in name.items()}
            return {frozenset(g for g in name if name[g] == x) for x in name.values()}

        assert set(found) <= set(want) and parts(found) == parts(want) and len(found) < len(set(group.tolist()))

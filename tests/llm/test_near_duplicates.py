"""N-gram Jaccard join, components and repeated passages against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest

from lakeingest.llm import ngram_join
from lakeingest.llm.components import components
from lakeingest.llm.ngram_join import keep_one_of_each_group, merge_short, ngram_jaccard_classes, probe_long
from lakeingest.llm.suffix_dedup import drop_later_passages, repeated_passages

from .fixtures import DOCUMENTS, documents, prose, rows, shingles, tokens


def brute_classes(data, similarity=75):
    """(doc_id, size, component) of each row; rows are linked, components are named by their smallest doc_id."""
    sets = [shingles(r[1]) for r in data]
    parent = list(range(len(data)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if o and 100 * o >= similarity * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(data):
        if r[0] is not None and sets[i]:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(data)), key=repr)


def families(n=150, seed=5):
    """Near copies in chains and stars around the threshold, and passages shared by unlike documents."""
    rng = random.Random(seed)
    out, common = [], prose(rng, 30)
    for i in range(n):
        if i % 5 == 0 or len(out) < 3:
            text = prose(rng, rng.randint(8, 90))
        else:
            words = tokens(rng.choice(out[-12:])[1])
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(["u", "v", "w"])
            if rng.random() < 0.3:
                words += tokens(prose(rng, rng.randint(1, 12)))
            text = " ".join(words)
        if i % 9 == 0:
            text += " " + common
        out.append((i, text, "en", "s", len(text), "n", i, "k"))
    return out


@pytest.mark.parametrize("data,short", [(rows(), 64), (families(), 64), (families(seed=6), 0)])
def test_classes_match_brute_force(spark, monkeypatch, data, short):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", short)     # 0: hubs by buckets finish every list
    got = ngram_jaccard_classes(documents(spark, data)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_classes(data)


def test_heavy_shingles_do_not_change_the_result(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HEAVY_LOCAL", 2)
    data = families(seed=7)
    got = ngram_jaccard_classes(documents(spark, data)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_classes(data)


def test_one_of_each_group_stays(spark):
    data = rows()
    kept = keep_one_of_each_group(documents(spark, data))
    assert kept.columns == DOCUMENTS.names
    got = [r.doc_id for r in kept.collect()]
    want = [d for d, _, c in brute_classes(data) if d is None or d == c]
    assert want.count(-5) == 1 and 1 not in want       # -5 names the component of 1
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert ngram_jaccard_classes(none).collect() == []
    assert keep_one_of_each_group(none).collect() == []
    assert repeated_passages(none).collect() == []
    assert drop_later_passages(none).collect() == []
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    linked = {x for a, b in edges if a != b for x in (a, b)}
    frame = spark.createDataFrame(edges, "a long, b long").repartition(7)
    assert {r.node: r.component for r in components(frame).collect()} == {x: find(x) for x in linked}


def test_divide_skip_parts():
    lists = [(7, [1, 3, 9]), (5, [3, 4]), (6, [3, 9, 12])]
    assert dict(merge_short(lists)) == {1: [7], 3: [5, 6, 7], 4: [5], 9: [6, 7], 12: [6]}
    own = np.array([2, 4, 6, 8, 10])
    assert probe_long(1, np.array([2, 3, 10, 11]), own, 3) == 3
    assert probe_long(0, np.array([1, 3, 5]), own, 4) < 4
    assert probe_long(2, np.array([], dtype=int), np.array([], dtype=int), 2) == 2


def brute_passages(data, k=50):
    """Word positions (first, later) of every row with doc_id, and the words a later row keeps."""
    where = defaultdict(set)
    for r in data:
        if r[0] is not None:
            w = tokens(r[1])
            for i in range(len(w) - k + 1):
                where[tuple(w[i:i + k])].add(r[0])
    out = []
    for r in data:
        w = tokens(r[1])
        first, later = set(), set()
        if r[0] is not None:
            for i in range(len(w) - k + 1):
                docs = where[tuple(w[i:i + k])]
                if len(docs) > 1:
                    (first if min(docs) == r[0] else later).update(range(i, i + k))
        out.append((r[0], first, later, [x for i, x in enumerate(w) if i not in later]))
    return out


@pytest.mark.parametrize("k,anchor", [(50, 16), (20, 5)])
def test_passages_match_brute_force(spark, k, anchor):
    data = rows()
    want = brute_passages(data, k)
    got = {"first": defaultdict(set), "later": defaultdict(set)}
    for r in repeated_passages(documents(spark, data), k, anchor).collect():
        assert r.end_word - r.start_word == r.n_words >= k
        got[r.role][r.doc_id].update(range(r.start_word, r.end_word))
    for role, at in (("first", 1), ("later", 2)):
        expected = defaultdict(set)
        for w in want:
            expected[w[0]] |= w[at]
        assert {d: s for d, s in expected.items() if s} == dict(got[role])


def test_later_passages_are_cut(spark):
    data = rows()
    kept = drop_later_passages(documents(spark, data))
    assert kept.columns == DOCUMENTS.names
    got = kept.collect()
    want = brute_passages(data)
    expected = sorted((d, tuple(left)) for d, _, later, left in want if d is not None and (left or not later))
    assert sorted((r.doc_id, tuple(tokens(r.text))) for r in got if r.doc_id is not None) == expected
    whole = {(r[0], r[1]) for (r, w) in zip(data, want) if not w[2]}
    assert whole <= {(r.doc_id, r.text) for r in got}
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)


def test_rows_of_a_repeated_doc_id_are_judged_by_their_own_text(spark):
    from lakeingest.llm.ngram_join import keep_one_of_each_group
    from lakeingest.session import ship_package
    ship_package(spark)
    rng = random.Random(8)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    near = " ".join(["other"] + c.split()[1:])
    data = [(1, a), (2, a), (2, b), (3, c), (3, d), (4, near), (3, near), (5, ""), (5, ""), (6, None), (None, a), (1, a)]
    docs = spark.createDataFrame([(*r, "g", "s", "r", "h", 1) for r in data],
                                 "doc_id long, text string, __gone string, __doc string, row string, h1 string, part int")
    kept = keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, a), (2, b), (3, min(c, near)), (3, d), (5, ""), (5, ""), (6, None), (None, a)], key=str)


def test_passages_are_cut_beside_columns_of_any_name(spark):
    from lakeingest.llm.suffix_dedup import drop_later_passages
    from lakeingest.session import ship_package
    ship_package(spark)
    rng = random.Random(9)
    passage = prose(rng, 60)
    docs = spark.createDataFrame([(1, passage, "x", "y", "z", 1), (2, "before " + passage + " after", "x", "y", "z", 2)],
                                 "doc_id long, text string, spans string, __span_doc string, Spans_ string, row int")
    got = {r.doc_id: r for r in drop_later_passages(docs).collect()}
    assert got[1].text == passage and got[2].text.split() == ["before", "after"] and got[2].spans == "x" and got[2].row == 2


@pytest.mark.parametrize("similarity", [75, 60])
def test_settling_in_one_task_equals_all_pairs(similarity):
    """Random sets around the threshold: the links' components are those of all linked pairs."""
    import numpy as np

    from lakeingest.llm.ngram_join import needed, settle
    rng = np.random.default_rng(similarity)
    bases = [rng.choice(400, 40, replace=False) for _ in range(12)]
    sets = []
    for i in range(150):
        base = bases[rng.integers(12)]
        keep = rng.random(len(base)) < 0.93
        sets.append(np.unique(np.concatenate([base[keep], rng.choice(400, rng.integers(0, 6))])).astype(np.int64))
    n = np.array([len(s) for s in sets])
    names, count = np.unique(np.concatenate(sets), return_counts=True)
    rank = dict(zip(names.tolist(), count.tolist()))
    listed = [np.array(sorted(s.tolist(), key=lambda x: (rank[x], x))[:len(s) - int(needed(len(s), similarity)) + 1]) for s in sets]
    node = rng.permutation(150) * 7

    def parts(links):
        root = {int(x): int(x) for x in node}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in links:
            root[find(a)] = find(b)
        groups = {}
        for x in root:
            groups.setdefault(find(x), set()).add(x)
        return sorted(map(sorted, groups.values()))

    want = [(int(node[i]), int(node[j])) for i in range(150) for j in range(i)
            if (100 + similarity) * len(np.intersect1d(sets[i], sets[j])) >= similarity * (n[i] + n[j])]
    got = settle(node, n, node.copy(), sets, listed, similarity)
    assert set(got) <= {(a, b) for a, b in want} | {(b, a) for a, b in want}
    assert parts(got) == parts(want) and 1 < len(parts(want)) < 150


def test_rounds_and_settling_agree(spark, monkeypatch):
    from lakeingest.llm import ngram_join as N
    from lakeingest.session import ship_package
    from tests.llm.fixtures import documents
    ship_package(spark)
    docs = documents(spark)
    settled = sorted(map(tuple, N.ngram_jaccard_classes(docs).collect()), key=str)
    monkeypatch.setattr(N, "SETTLE_PAIRS", -1)
    assert sorted(map(tuple, N.ngram_jaccard_classes(docs).collect()), key=str) == settled


def _near_copies(spark):
    """Two bases with near copies on either side of the threshold, single rows, and documents that only share a base's words."""
    rng = random.Random(11)
    rows = []
    for base in range(2):
        words = [f"b{base}w{i}" for i in range(60)]
        for _ in range(70):
            own = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
                own[rng.randrange(60)] = f"x{rng.randrange(40)}"
            rows.append(" ".join(own))
    rows += [" ".join(f"s{i}v{j % 3}" for j in range(20)) for i in range(30) for _ in range(2)]
    return spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "doc_id long, text string")


@pytest.mark.parametrize("shingles, pairs, together", [(300, 2_000, 1), (100_000, 1_000, 50), (1_000, 400_000_000, 1)])
def test_large_groups_are_settled_in_parts_without_rounds(spark, monkeypatch, shingles, pairs, together):
    from lakeingest.llm import ngram_join as N
    from lakeingest.session import ship_package
    ship_package(spark)
    docs = _near_copies(spark)
    texts = {r.doc_id: r.text.split() for r in docs.collect()}
    sets = {i: {tuple(w[j:j + 5]) for j in range(len(w) - 4)} for i, w in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low

    def no_round(*args):
        raise AssertionError("a round of searches")
    monkeypatch.setattr(N, "search", no_round)
    monkeypatch.setattr(N, "SETTLE_SHINGLES", shingles)
    monkeypatch.setattr(N, "SETTLE_PAIRS", pairs)
    monkeypatch.setattr(N, "SETTLE_TOGETHER", together, raising=False)
    monkeypatch.setattr(N, "SETTLE_CUTS", 1000, raising=False)
    got = {r.doc_id: r.component_id for r in N.ngram_jaccard_classes(docs).collect()}
    assert got == {i: find(i) for i in sets}
    assert 40 < len(set(got.values())) < 150


def test_pipeline_drops_near_copies_of_large_groups_without_rounds(spark, monkeypatch):
    import corpus_pipeline
    from lakeingest.llm import ngram_join as N
    from lakeingest.session import ship_package
    ship_package(spark)
    docs = _near_copies(spark)
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"]
    want = {(r.doc_id, r.text) for r in docs.collect()
            if r.doc_id in {x.component_id for x in ngram_jaccard_classes(docs).collect()}}

    def no_round(*args):
        raise AssertionError("a round of searches")
    monkeypatch.setattr(N, "search", no_round)
    monkeypatch.setattr(N, "SETTLE_SHINGLES", 500)
    got = [(r.doc_id, r.text) for r in stage(spark, docs, "").collect()]
    assert len(got) == len(want) and set(got) == want


def test_groups_of_too_much_work_take_a_round_and_the_others_do_not(spark, monkeypatch):
    from lakeingest.llm import ngram_join as N
    from lakeingest.session import ship_package
    ship_package(spark)
    docs = _near_copies(spark)
    want = sorted(map(tuple, N.ngram_jaccard_classes(docs).collect()))
    seen, search = [], N.search

    def counted(lists, *args):
        seen.append(lists.select("node").distinct().count())
        return search(lists, *args)
    monkeypatch.setattr(N, "search", counted)
    monkeypatch.setattr(N, "SETTLE_TOGETHER", 1)
    monkeypatch.setattr(N, "SETTLE_PAIRS", 1_000)
    monkeypatch.setattr(N, "SETTLE_CUTS", 1)
    assert sorted(map(tuple, N.ngram_jaccard_classes(docs).collect())) == want
    assert seen and seen[0] < docs.select("text").distinct().count()


def test_settling_in_parts_equals_settling_at_once():
    """Each slice of what asks against each block of what is held, and lists of a component that is not searched for itself."""
    from lakeingest.llm.ngram_join import settle
    rng = np.random.default_rng(5)
    base = rng.choice(300, 40, replace=False)
    sets = [np.unique(np.concatenate([base[rng.random(40) < 0.92], rng.choice(300, rng.integers(0, 4))])).astype(np.int64)
            for _ in range(90)]
    node, n = rng.permutation(90).astype(np.int64), np.array([len(s) for s in sets])
    linked = [(i, j) for i in range(90) for j in range(i)
              if 175 * len(np.intersect1d(sets[i], sets[j])) >= 75 * (n[i] + n[j])]

    def joined(edges, start):
        root = list(start)
        for a, b in edges:
            root = [root[a] if x == root[b] else x for x in root]
        names = {}
        return [names.setdefault(x, k) for k, x in enumerate(root)]
    # a first component: what is linked to the first document
    comp = np.array([0 if i == 0 or (i, 0) in linked else i for i in range(90)], dtype=np.int64)
    none = sets[0][:0]
    listed = [none if comp[i] == 0 else sets[i] for i in range(90)]
    large = [sets[i] if comp[i] == 0 else none for i in range(90)]
    at = {int(x): i for i, x in enumerate(node)}
    found = []
    for slot in range(3):
        for block in range(2):
            asks, held = (node % 3 == slot) & (comp != 0), node % 2 == block
            use = asks | held
            pick = np.flatnonzero(use)
            found += settle(node[use], n[use], comp[use], [sets[i] for i in pick], [listed[i] for i in pick], 75,
                            [large[i] for i in pick], held[use], asks[use])
    found = [(at[a], at[b]) for a, b in found]
    assert {tuple(sorted(x, reverse=True)) for x in found} <= set(linked)
    assert joined(found, comp) == joined(linked, comp)


def test_passages_are_told_apart_by_both_halves_of_their_key():
    """Entries that share 64 bits of a key by chance are no passage, in the map step and after the shuffle."""
    from lakeingest.llm.suffix_dedup import _MARK, _compare, _local
    from lakeingest.llm.exchange import by_kind, unpack

    def marks(check, doc):
        n = len(doc)
        zeros = np.zeros(n, dtype=np.uint64)
        found = []
        for split in (n, 1):        # all in one task, or one entry a task
            batches = [b for at in range(0, n, split) for b in _local(
                zeros[at:at + split] + np.uint64(7), np.array(check[at:at + split], dtype=np.uint64),
                np.array(doc[at:at + split]), np.arange(at, min(n, at + split), dtype=np.uint32), zeros[at:at + split], 1)]
            blocks = by_kind(_compare(1)(batches))
            found.append(sorted((kind, int(d)) for kind, bs in blocks.items() for b in bs for d in unpack(b, _MARK)[0]))
        assert found[0] == found[1]
        return found[0]
    assert marks([1, 2, 3], [10, 11, 12]) == []
    assert marks([1, 2, 1, 1], [10, 11, 12, 13]) == [(0, 10), (1, 12), (1, 13)]

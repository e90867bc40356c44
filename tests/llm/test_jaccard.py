import itertools
import random

import pyarrow as pa
import pytest

from roamrank.llm import jaccard_join
from tests.llm.fixtures import awkward, documents, words


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    w = [x for x in lower.split(" ") if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Every row's set, links between rows, and the smallest id of each row's component."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = set()
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * len(sets[i] | sets[j]):
            links.add((i, j))
            root[find(j)] = find(i)
    smallest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            k = find(i)
            smallest[k] = min(smallest.get(k, r[0]), r[0])
    return sets, links, [smallest.get(find(i)) for i in range(len(rows))]


def edited(rng, text, n):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = words(rng, 1)
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    base, passage = words(rng, 150), words(rng, 60)
    rows = [(i, edited(rng, base, rng.randrange(0, 4))) for i in range(120, 0, -1)]  # near copies of one text
    rows += [(200 + i, words(rng, rng.randrange(1, 100))) for i in range(60)]
    rows += [(300 + i, f"{words(rng, rng.randrange(3, 60))} {passage} {words(rng, 9)}") for i in range(60)]
    chain = words(rng, 100)
    for i in range(25):  # each near the one before, the ends far from each other
        chain = edited(rng, chain, 1) + (" " + words(rng, 2))
        rows.append((400 + i, chain))
    rows += [(500 + i, "same words in the same order here") for i in range(40)]
    rows += [(600, "A B c d"), (601, "a b C D"), (602, "a\tb\nc  d"), (603, "a b c d e"), (604, "a b c d"), (605, "É é a b c")]
    rows += [(606, "é é a b c"), (607, base.upper()), (608, f"{base} {passage}")]
    return rows


def found(spark, rows, **options):
    got = jaccard_join.grouped(documents(spark, rows)).collect()
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got)


def test_components(spark, rows):
    sets, _, component = brute(rows)
    assert found(spark, rows) == sorted((r[0], len(s), c if s else r[0]) for r, s, c in zip(rows, sets, component))


def test_components_with_every_list_cut_and_frequent_shingles(spark, rows, monkeypatch):
    for name, value in (("SHORT", 3), ("LIST", 6), ("OFTEN", 2), ("BLOCK", 4), ("COLUMNS", 16)):
        monkeypatch.setattr(jaccard_join, name, value)
    sets, _, component = brute(rows)
    assert found(spark, rows) == sorted((r[0], len(s), c if s else r[0]) for r, s, c in zip(rows, sets, component))


def test_all_links(spark, rows):
    joined = jaccard_join.join(documents(spark, rows), all_links=True)
    kinds = {}
    for r in joined.members.collect():
        kinds.setdefault(r["class"], []).append(r["doc_id"])
    got = set()
    for r in joined.links.collect():
        got |= {tuple(sorted(p)) for p in itertools.product(kinds[r["a"]], kinds[r["b"]])}
    sets, links, _ = brute(rows)
    expected = {tuple(sorted((rows[i][0], rows[j][0]))) for i, j in links if sets[i] != sets[j]}
    assert got == expected
    assert len(joined.links.collect()) == joined.links.distinct().count()


def test_awkward_rows(spark):
    rows = awkward()
    sets, _, component = brute(rows)
    got = jaccard_join.grouped(documents(spark, rows))
    key = lambda r: tuple((x is None, x) for x in r)
    expected = ((r[0], len(s), c if s else r[0]) for r, s, c in zip(rows, sets, component))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)
    assert jaccard_join.grouped(documents(spark, rows).limit(0)).count() == 0
    assert jaccard_join.grouped(documents(spark, [(1, None), (2, "")])).count() == 2


def test_one_of_each_group(spark, rows):
    odd = [(None if r[0] is None else r[0] + 3000, r[1]) for r in awkward()]
    more = [*rows, *odd, (900, rows[0][1]), (900, rows[0][1]), (901, None), (901, None)]
    docs = documents(spark, more)
    kept = jaccard_join.distinct_documents(docs)
    assert kept.columns == docs.columns
    sets, _, component = brute(more)
    firsts = sorted({c for s, c in zip(sets, component) if s and c is not None})
    got = [r["doc_id"] for r in kept.where(r"text RLIKE '[^\\s]'").collect()]
    ids = sorted(i for i in got if i is not None)
    # Of equal ids, the components are told apart by their texts alone.
    assert sorted(set(ids)) == firsts and ids.count(3005) == 2 and len(ids) == len(firsts) + 1
    assert got.count(None) == 1
    assert kept.where("text IS NULL").count() == sum(t is None for _, t in more)
    assert jaccard_join.distinct_documents(docs.limit(0)).count() == 0


def test_smallest_root_of_long_chains(spark):
    n = 3000
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(i, i + 1) for i in order[:-1] if i < n - 1 and i != 1500], "a bigint, b bigint")
    roots = {r["class"]: r["root"] for r in jaccard_join.components(links.repartition(13)).collect()}
    skipped = order[-1]
    cuts = sorted({1500, skipped} - {n - 1})
    for i in range(n):
        start = max([0, *[c + 1 for c in cuts if c < i]])
        assert roots.get(i, i) == start


def test_roots_by_rounds_and_in_one_task_are_the_same(spark, monkeypatch):
    rng = random.Random(8)
    pairs = [(rng.randrange(-900, 900), rng.randrange(-900, 900)) for _ in range(1100)]
    links = spark.createDataFrame([p for p in pairs if p[0] != p[1]], "a bigint, b bigint").repartition(13)
    at_once = sorted(map(tuple, jaccard_join.components(links).collect()))
    monkeypatch.setattr(jaccard_join, "JOINED", 100)
    assert sorted(map(tuple, jaccard_join.components(links).collect())) == at_once
    assert len({c for c, _ in at_once}) == len(at_once) and all(r < c for c, r in at_once)
    assert jaccard_join.components(links.limit(0)).count() == 0


def test_tasks_follow_the_rows_not_the_setting(spark, rows):
    """With hundreds of shuffle partitions that nothing merges, few of the tasks write files or run Python."""
    held = {"spark.sql.shuffle.partitions": "101", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    docs, context = documents(spark, rows), spark.sparkContext
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        context.setJobGroup("held", "held")
        sets, _, component = brute(rows)
        expected = {c if s else r[0] for r, s, c in zip(rows, sets, component)}
        assert {r["doc_id"] for r in jaccard_join.distinct_documents(docs).collect()} == expected
        jobs = [context.statusTracker().getJobInfo(j) for j in context.statusTracker().getJobIdsForGroup("held")]
        stages = {i for j in jobs for i in j.stageIds}
        tasks = sum(x.numCompletedTasks for i in stages if (x := context.statusTracker().getStageInfo(i)))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 0 < tasks < 5_500, tasks


def test_long_lists_send_on_whom_prefixes_allow():
    """Each linked pair passes in the list of its first common shingle, and few others do."""
    rng = random.Random(17)
    base = sorted(rng.sample(range(10_000), 120))
    kept = [sorted({x for x in base if rng.random() > p} | set(rng.sample(range(10_000), rng.randrange(9)))) for p in [0.01, 0.06, 0.2] * 15]
    lists = {}
    for k, own in enumerate(kept):
        prefix = own[: jaccard_join.prefix_length(len(own))]
        for place, shingle in enumerate(prefix):
            lists.setdefault(shingle, []).append((len(own), k, place, prefix))
    links = {
        (a, b) for a, b in itertools.combinations(range(len(kept)), 2)
        if 100 * len(set(kept[a]) & set(kept[b])) >= 80 * len(set(kept[a]) | set(kept[b]))
    }
    assert links
    sent, passed = 0, {}
    for shingle, rows in lists.items():
        n, kind, place, prefix = zip(*sorted(rows))
        columns = {"i": [0] * len(n), "j": [0] * len(n), "class": kind, "n": n, "place": place, "component": kind}
        table = pa.table({**columns, "own": [0] * len(n), "prefix": pa.array(prefix, pa.list_(pa.int64()))})
        for batch in jaccard_join._likely(table, False):
            passed.setdefault(shingle, set()).update(batch.column("class").to_pylist())
            sent += batch.num_rows
    for a, b in links:
        assert {a, b} <= passed[min(set(kept[a]) & set(kept[b]))]
    assert sent < sum(map(len, lists.values())) / 2

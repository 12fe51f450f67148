import random
import time

from pyspark.sql import functions as F

from turnlens.llm.linking import components, verified_groups


def brute_roots(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in root}


def test_components_of_random_graphs_and_a_long_path(spark):
    rng = random.Random(3)
    for edges in (
        [(rng.randrange(200), rng.randrange(200)) for _ in range(150)],
        [(i, i + 1) for i in range(90)] + [(500, 499)],
        [(i, 0) for i in range(1, 300)],
        [],
    ):
        links = spark.createDataFrame(edges, "a long, b long")
        got = {r.id: r.root for r in components(links).collect()}
        want = {x: r for x, r in brute_roots([e for e in edges if e[0] != e[1]]).items() if x != r}
        assert got == want


def test_every_similar_pair_ends_in_one_group_even_under_one_popular_key(spark):
    # 60 unlike rows and 20 pairs of like rows share one key; like rows have the same value.
    rows = [(i, 7, 1000 + i) for i in range(60)] + [(100 + i, 7, i // 2) for i in range(40)]
    rows += [(i, 20 + i % 5, v) for i, _, v in rows]
    frame = spark.createDataFrame(rows, "id long, key long, value long")
    values = frame.select("id", "value").distinct()

    keyed = frame.groupBy("id").agg(F.collect_set("key").alias("keys"))

    def verify(pairs):
        x, y = values.toDF("a", "x"), values.toDF("b", "y")
        return pairs.join(x, "a").join(y, "b").filter("x = y")

    roots = {r.id: r.root for r in verified_groups(keyed, verify).collect()}
    assert roots == {101 + 2 * i: 100 + 2 * i for i in range(20)}


def grouped(spark, keyed, like, **how):
    """Groups under the likeness of the pairs ``like``, which need not be transitive."""
    rows = spark.createDataFrame([(i, list(k)) for i, k in keyed.items()], "id long, keys array<long>")
    true = spark.createDataFrame(sorted({tuple(sorted(p)) for p in like}), "a long, b long")
    return {r.id: r.root for r in verified_groups(rows, lambda p: p.join(true, ["a", "b"]), **how).collect()}


def test_rows_unlike_the_smallest_of_their_only_key(spark):
    assert grouped(spark, {0: [7], 1: [7], 2: [7]}, [(1, 2)]) == {2: 1}


def test_groups_meet_by_members_that_are_not_the_smallest(spark):
    # Two groups of two, and their second members alike under a key of a later batch.
    keyed = {1: [4, 7], 2: [4, 7], 3: [8, 7], 4: [8, 7]}
    assert grouped(spark, keyed, [(1, 2), (3, 4), (2, 4)]) == {2: 1, 3: 1, 4: 1}


def test_chains_under_popular_keys_with_default_rounds(spark):
    rng = random.Random(8)
    keyed = {i: sorted({rng.randrange(6), *rng.sample(range(50, 90), 2)}) for i in range(120)}
    near = lambda i, j: 0 < (j - i) % 120 <= 3 and rng.random() < 0.8
    like = [(i, j) for i in keyed for j in keyed if i < j and near(i, j)]
    want = brute_roots([(i, j) for i, j in like if set(keyed[i]) & set(keyed[j])])
    for choices in (2, 16):
        assert grouped(spark, keyed, like, choices=choices) == {x: r for x, r in want.items() if x != r}


def test_no_keys(spark):
    none = spark.createDataFrame([(1, [])], "id long, keys array<long>")
    assert verified_groups(none, lambda p: p).collect() == []


def test_pinned_tables_leave_no_shuffle_files(spark):
    from turnlens.llm.common import Scratch
    from turnlens.sources.tables import SHUFFLE_CLEANUP_CONF, pin

    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f.toString() for f in _scala_list(folder.getAllFiles()) if f.getName().startswith("shuffle_")}

    def _scala_list(seq):
        return [seq.apply(i) for i in range(seq.size())]

    before, set_before = files(), spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    counted = spark.range(5000).groupBy((F.col("id") % 50).alias("k")).count()
    scratch = Scratch(spark)
    made = [scratch.pin(counted, "x"), scratch.bucketed(counted, "k", "y"), pin(counted.repartition(3), "z")]
    for _ in range(50):  # files go in the background
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(SHUFFLE_CLEANUP_CONF, None) == set_before
    assert [m.count() for m in made] == [50] * 3
    scratch.drop()

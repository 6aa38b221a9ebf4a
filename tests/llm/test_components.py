import random

from gleanery.llm.components import components


def check(spark, links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}


def test_chains_stars_and_random_links(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(1, 40)]
    star = [(100, i) for i in range(101, 160)]
    some = [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    links = [*chain, *star, *some, (7, 7), (100, 101), (-5, 390)]
    rng.shuffle(links)
    check(spark, links)


def test_no_links(spark):
    check(spark, [])

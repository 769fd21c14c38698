"""The set-at-a-time crawl order against one queue worked off page by page."""

import random

from sitelens.operators import frontier_order as FO

RANK = {"high": 0, "medium": 1, "low": 2}


def one_by_one(seed, links, sections, required):
    queue, visited, found = [(0, 0, seed)], [], set()
    came = 1
    while queue:
        queue.sort()
        cls, _, url = queue.pop(0)
        if url in [u for u, _ in visited]:
            continue
        visited.append((url, cls))
        found |= sections.get(url, set())
        if required and found >= set(required):
            break
        for _, dst, priority in sorted(x for x in links.get(url, [])):
            queue.append((RANK[priority], came, dst))
            came += 1
    return [u for u, _ in visited]


def test_order_equals_one_queue(spark):
    rnd = random.Random(9)
    links, rows, seeds, sections = {}, [], [], {}
    for s in range(16):
        n = rnd.randrange(2, 8)
        for u in range(n):
            for k in range(rnd.randrange(4)):
                dst, priority = f"s{s}/{rnd.randrange(n)}", rnd.choice(["high", "high", "medium", "low"])
                links.setdefault(f"s{s}/{u}", []).append((k, dst, priority))
                rows.append((f"s{s}/{u}", dst, k, priority))
            sections[f"s{s}/{u}"] = set(rnd.sample("ABCD", rnd.randrange(3)))
        seeds.append((f"s{s}", f"s{s}/0"))
    frame = spark.createDataFrame(rows, "src string, dst string, link_seq int, priority string")
    start = spark.createDataFrame(seeds, "entity string, url string")
    found = spark.createDataFrame([(u, x) for u, v in sections.items() for x in v], "url string, section string")
    for required in (["A", "B", "C"], []):
        got = {}
        for r in sorted(FO.crawl_in_order(start, frame, found, required).collect(), key=lambda r: r.pos):
            assert r.pos == len(got.setdefault(r.entity, []))
            got[r.entity].append(r.url)
        assert got == {s: one_by_one(u, links, sections, required) for s, u in seeds}


def test_no_links_and_no_seeds(spark):
    links = spark.createDataFrame([], "src string, dst string, link_seq int, priority string")
    seeds = spark.createDataFrame([("s", "u")], "entity string, url string")
    assert [(r.url, r.pos, r.priority) for r in FO.crawl_in_order(seeds, links).collect()] == [("u", 0, "high")]
    assert FO.crawl_in_order(seeds.limit(0), links).count() == 0

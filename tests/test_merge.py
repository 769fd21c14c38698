import functools
import itertools
import json
import random

from sitelens.operators import merge as MG


def run_merge(spark, seqs, schema_keys=None):
    """seqs: {entity: [fragment, ...]} -> {entity: merged dict}"""
    rows = [(e, i, f if isinstance(f, str) else json.dumps(f)) for e, frs in seqs.items() for i, f in enumerate(frs)]
    df = spark.createDataFrame(rows, "entity string, seq bigint, json string")
    merged, items, errors = MG.merge_fragments(df, schema_keys)
    out = {}
    nodes = [(r.entity, list(r.path), r.kind, r.value) for r in merged.collect()]
    its = [(r.entity, list(r.path), r.seq, r.idx, r.kind, r.value) for r in items.collect()]
    for e in {n[0] for n in nodes} | set(seqs):
        out[e] = MG.assemble([n[1:] for n in nodes if n[0] == e], [i[1:] for i in its if i[0] == e])
    return out, errors


def fold(frs, schema_keys=None):
    docs = []
    for f in frs:
        d = json.loads(f) if isinstance(f, str) else f
        if not isinstance(d, dict):
            continue
        for k in schema_keys or []:
            d.setdefault(k, {})
        docs.append(d)
    return settle([d for d in docs if d] or [{}])


def settle(values):
    """Merged value of one key by replaying its occurrences in order: the
    occurrences that make it up are kept, and objects are settled key by key."""
    parts = values[:1]
    for v in values[1:]:
        both = {type(parts[0]), type(v)}
        if both == {dict}:
            parts.append(v)
        elif both == {list}:
            parts = [functools.reduce(lambda seen, x: seen if x in seen else [*seen, x], v, parts[0])]
        elif v and not any(parts):
            parts = [v]
    if isinstance(parts[0], dict):
        return {k: settle([p[k] for p in parts if k in p]) for k in dict.fromkeys(itertools.chain(*parts))}
    return parts[0]


def test_golden_cases(spark):
    seqs = {
        "scalars": [{"a": 0}, {"a": None}, {"a": "x"}, {"a": "y"}],
        "lists1": [{"a": [1]}, {"a": [2, 2, 1, 3]}],
        "lists2": [{"b": 1}, {"a": [1, 1]}],
        "lists3": [{"a": []}, {"a": [1, 1]}],
        "order": [{"a": [1]}, {"a": "x"}, {"a": [2]}],
        "placeholder": [{"a": {}}, {"a": "x"}, {"a": {"k": 1}}],
        "nested": [{"a": {"b": 1}}, {"a": "x"}, {"a": {"c": [1, {"z": 1}]}}, {"a": {"c": [{"z": 1}, 2]}}],
        "falsy_stays": [{"a": ""}, {"a": 0}, {"a": False}],
    }
    got, _ = run_merge(spark, seqs)
    assert got["scalars"] == {"a": "x"}
    assert got["lists1"] == {"a": [1, 2, 3]}
    assert got["lists2"] == {"b": 1, "a": [1, 1]}
    assert got["lists3"] == {"a": [1]}
    assert got["order"] == {"a": [1, 2]}
    assert got["placeholder"] == {"a": "x"}
    assert got["nested"] == {"a": {"b": 1, "c": [1, {"z": 1}, 2]}}
    assert got["falsy_stays"] == {"a": ""}
    for e, frs in seqs.items():
        assert got[e] == fold(frs), e


def test_bad_json_routed_and_schema_fill(spark):
    seqs = {"s": ["{bad", "[1]", "{}"]}
    got, errors = run_merge(spark, seqs, ["x", "y"])
    assert got["s"] == {"x": {}, "y": {}}
    bad = sorted((r.reason, r.position, r.context) for r in errors.collect())
    assert [b[0].split(":")[0] for b in bad] == ["invalid JSON", "not an object"]
    assert bad[0][1] > 0 and bad[0][2]


def _rand_value(rng, depth=0):
    r = rng.random()
    if depth < 2 and r < 0.25:
        return {rng.choice("abc"): _rand_value(rng, depth + 1) for _ in range(rng.randint(0, 2))}
    if r < 0.5:
        return [rng.choice([0, 1, 2, "", "u", None, 3.5]) for _ in range(rng.randint(0, 3))]
    return rng.choice([0, 1, 2, "", "u", "v", None, False, 3.5])


def test_relational_merge_equals_fold_on_random_sequences(spark):
    rng = random.Random(7)
    seqs = {}
    for e in range(300):
        seqs[f"e{e}"] = [{rng.choice("abc"): _rand_value(rng) for _ in range(rng.randint(0, 3))}
                         for _ in range(rng.randint(1, 5))]
    got, _ = run_merge(spark, seqs)
    bad = [e for e, frs in seqs.items() if got[e] != fold(frs)]
    assert not bad, (bad[:3], [seqs[b] for b in bad[:1]], [got[b] for b in bad[:1]])


def test_what_the_reader_accepts_and_too_deep_documents(spark):
    deep = '{"a":' * 100_000 + "1" + "}" * 100_000
    got, errors = run_merge(spark, {"s": ['{"a":1,"a":2}', '{"c":NaN}', deep, '{"a":3']})
    assert got["s"]["a"] == 2 and got["s"]["c"] != got["s"]["c"]
    rows = {r.seq: r for r in errors.collect()}
    assert set(rows) == {2, 3} and rows[2].reason == "nested too deeply"
    assert rows[3].position == 6 and rows[3].context == '{"a":3'


def test_items_are_dealt_anew_before_they_are_grouped(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([("s", 0, '{"a":[1]}'), ("s", 1, '{"a":[2]}')], "entity string, seq bigint, json string")
        _, items, _ = MG.merge_fragments(df)
        plan = items._jdf.queryExecution().executedPlan().toString()
        above = plan[:plan.index("SortMergeJoin [entity")]
        assert "canon" in plan and "Exchange hashpartitioning(entity" in above
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

"""JSON trees of any depth: region nodes and lost members against plain recursion."""

import collections
import json
import random

from spanloom.sources import histories, trees


def made(rng, depth):
    kind = rng.random()
    if depth == 0 or kind < 0.2:
        return rng.choice([1, "t", None, True, "", -7, "ї"])
    if kind < 0.5:
        return [made(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    out = {k: made(rng, depth - 1) for k in rng.sample(["a", "b", "c", "x y", "it's"], rng.randint(0, 3))}
    if rng.random() < 0.6:
        out |= {"regionId": rng.choice([rng.randint(1, 9), str(rng.randint(1, 9)), None]), "regionName": rng.choice([f" N{rng.randint(1, 4)} ", "", None, "  "]), "regionType": rng.choice(["State", None])}
    return out


def plain_nodes(value, parent=None):
    out = []
    if isinstance(value, list):
        for x in value:
            out += plain_nodes(x, parent)
    elif isinstance(value, dict):
        name = str(value.get("regionName") or "").strip()
        if value.get("regionId") is not None and name:
            out.append((str(value["regionId"]), name, parent))
            parent = str(value["regionId"])
        for x in value.values():
            out += plain_nodes(x, parent)
    return out


def test_nodes_of_any_depth(spark):
    rng = random.Random(1)
    docs = [made(rng, 9) for _ in range(40)] + [{"regionId": 1, "regionName": "deep", "c": [[[[{"regionId": 2, "regionName": "deeper"}]]]]}]
    rows = [(json.dumps(d),) for d in docs] + [(None,), ("{bad",), ("",), ("7",), ("[]",)]
    found = trees.nodes(spark.createDataFrame(rows, "body string"), "body").collect()
    want = collections.defaultdict(set)
    for d in docs:
        for i, n, p in plain_nodes(d):
            want[i, n].add(p)
    assert len(want) > 10 and {(r.id, r.name): r.parent for r in found} == {k: min((p for p in v if p is not None), default=None) for k, v in want.items()}
    assert trees.nodes(spark.createDataFrame([], "body string"), "body").count() == 0


def test_hierarchy_is_a_case_of_it(spark):
    body = {"states": [{"stateId": "1", "stateName": "S", "districts": [{"districtId": "2", "districtName": "D", "communities": [{"communityId": "3", "communityName": "C"}, {"communityId": "4", "communityName": ""}]}]}]}
    found = histories.hierarchy(spark.createDataFrame([(json.dumps(body),)], "body string"), "body").collect()
    assert {tuple(r) for r in found} == {("state", "1", "S", None), ("district", "2", "D", "1"), ("community", "3", "C", "2")}


def canonical(x):
    return json.dumps(x, sort_keys=True, ensure_ascii=False)


def plain_lost(old, new, path=()):
    """What the recursion of the rule finds, with where."""
    if new is None:
        return [(path, "member", 1)]
    if isinstance(old, dict):
        if not isinstance(new, dict):
            return [(path, "shape", 1)]
        return [x for k, v in old.items() for x in (plain_lost(v, new[k], (*path, k)) if k in new else [((*path, k), "member", 1)])]
    if isinstance(old, list):
        if not isinstance(new, list):
            return [(path, "shape", 1)]
        n = sum((collections.Counter(map(canonical, old)) - collections.Counter(map(canonical, new))).values())
        return [(path, "element", n)] if n else []
    return []


def changed(rng, value):
    if isinstance(value, dict):
        return {k: changed(rng, v) for k, v in value.items() if rng.random() > 0.1} | ({"new": 1} if rng.random() < 0.2 else {})
    if isinstance(value, list):
        return [x for x in value if rng.random() > 0.2] + ([5] if rng.random() < 0.3 else [])
    return rng.choice([value, value, value, None, [], {}, "other"])


def test_lost_members(spark):
    rng = random.Random(2)
    old = {i: made(rng, 7) for i in range(150)} | {900: {"a": {"b": {"c": 1}}}, 901: [1, 1, {"x": 1, "y": 2}], 902: {"a": 1}}
    new = {i: changed(rng, d) if i % 5 else d for i, d in old.items()} | {900: {"a": {"b": {}}}, 901: [{"y": 2, "x": 1}, 1]}
    del new[902]
    make = lambda d: spark.createDataFrame([(k, json.dumps(v)) for k, v in d.items()], "k long, body string")
    found = collections.defaultdict(set)
    for r in trees.not_retained(make(old), make(new), "k", "body").collect():
        found[r.key].add((tuple(r.path), r.lost, r.n))
    want = {k: set(plain_lost(old[k], new[k])) for k in new if json.dumps(old[k]) != json.dumps(new[k])}
    want = {k: v for k, v in want.items() if v} | {902: {((), "document", 1)}}
    assert dict(found) == want and found[900] == {(("a", "b", "c"), "member", 1)} and found[901] == {((), "element", 1)}


def test_groups_by_name_and_fallback_ids(spark):
    body = [{"regionName": " Суми ", "alarms": [{"alertType": "AIR", "regionId": "7"}]}, {"regionId": "5", "regionName": "Суми", "alarms": [{"alertType": "AIR"}] * 2}, {"regionId": "6", "regionName": "", "alarms": [{}]}, {"regionId": "8", "regionName": "x", "alarms": None}]
    rows = spark.createDataFrame([(json.dumps(body),)], "body string")
    from pyspark.sql import functions as F

    found = histories.alarms(rows, "body", F.lit("fallback")).select("region_id").collect()
    assert sorted(r.region_id for r in found) == ["5", "5", "6", "fallback"]
    assert [tuple(r) for r in histories.groups_by_name(histories.alarms(rows, "body")).collect()] == [("Суми", "5", 3)]


def test_trees_are_read_once_whatever_their_depth(spark):
    """Deep trees take one job without a table for each level; ids that are numbers or truth values are texts."""
    deep = {"regionId": 0, "regionName": "n0"}
    for i in range(1, 120):
        deep = {"regionId": i, "regionName": f"n{i}", "below": [deep]}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("deep", "deep")
    found = {(r.id, r.parent) for r in trees.nodes(spark.createDataFrame([(json.dumps(deep),)], "body string"), "body").collect()}
    jobs = len(tracker.getJobIdsForGroup("deep"))
    spark.sparkContext.setJobGroup("rest", "rest")
    assert found == {(str(i), str(i + 1) if i < 119 else None) for i in range(120)} and jobs < 10
    odd = ['{"regionId":1.50,"regionName":"a"}', '{"regionId":true,"regionName":"b"}', '{"regionId":[1],"regionName":"c"}', '{"regionId":1,"regionId":2,"regionName":"d"}', '{"regionId":NaN,"regionName":"e"}']
    assert {(r.id, r.name) for r in trees.nodes(spark.createDataFrame([(x,) for x in odd], "body string"), "body").collect()} == {("1.5", "a"), ("true", "b")}


def test_lost_members_take_one_plan_and_know_equal_numbers(spark):
    make = lambda *x: spark.createDataFrame(list(enumerate(x)), "k long, body string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lost", "lost")
    lost = trees.not_retained(make("[1, true]", "[1.0, {}]", '{"a":[1,1]}'), make("[1, 1]", "[{}, 1]", '{"a":[1],"b":2}'), "k", "body").collect()
    jobs = len(tracker.getJobIdsForGroup("lost"))
    spark.sparkContext.setJobGroup("rest", "rest")
    assert jobs < 10
    assert {(r.key, tuple(r.path), r.lost, r.n) for r in lost} == {(0, (), "element", 1), (2, ("a",), "element", 1)}


def test_versions_dealt_by_their_key_meet_without_another_shuffle(spark):
    from spanloom.plans import document_queries

    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = document_queries.lost_members(spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
        whole = document_queries.lost_members(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "coalesce(key" not in plan and whole.count("Exchange hashpartitioning") == 8
    assert not [x for x in plan.splitlines() if "Join [" in x and "StructsToJson" in x]  # a text is made once


def test_equal_ends_of_lists_are_not_hashed(monkeypatch):
    asked = []
    frozen = trees.frozen
    monkeypatch.setattr(trees, "frozen", lambda x: asked.append(x) or frozen(x))
    line = lambda i: {"n": i, "of": {"part": i * 7}}
    lines = [line(i) for i in range(9)]
    for new, n in ((lines, 0), (lines[1:], 1), (lines + lines[:1], 0), (lines[:4] + lines[5:], 1), ([], 9)):
        assert [x for *_, x in trees.lost_parts({"l": lines}, {"l": new}, plain=True)] == ([n] if n else [])
    assert not asked
    rng = random.Random(3)
    for _ in range(300):
        old, new = ([rng.choice([1, 2, "a", None, [1], {"b": 2}]) for _ in range(rng.randint(0, 6))] for _ in "ab")
        assert [*trees.lost_parts(old, new, plain=True)] == [*trees.lost_parts(old, new)]


def test_null_keys_and_truth_values(spark):
    make = lambda *x: spark.createDataFrame(x, "k long, body string")
    old, new = make((None, "[1,2]"), (1, "[1,true]"), (2, None), (3, "{"), (4, "[1]")), make((None, "[1]"), (1, "[true,true]"), (2, "[1]"), (3, "[1]"))
    found = {(r.key, r.lost, r.n) for r in trees.not_retained(old, new, "k", "body").collect()}
    assert found == {(None, "element", 1), (1, "element", 1), (4, "document", 1)}
    keyed = {(r.key, r.lost, r.n) for r in trees.not_retained(old.where("k > 0"), new.where("k > 0"), "k", "body", null_keys=False).collect()}
    assert keyed == found - {(None, "element", 1)}

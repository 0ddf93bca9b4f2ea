"""Ledger, observations, ingest, proofs, sources and streams on small tables."""

import base64
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from spanloom.functions import times, words
from spanloom.operators import coverage, ingest, ledger, observations, proofs, snapshot
from spanloom.sources import captures, histories, pages, sinks
from spanloom.streaming import polls


def test_cumulative_totals_do_not_add_up(spark):
    rows = [("i", "cumulative", n, 0, t) for t, n in enumerate([18, 20, 23, 23])]
    make = lambda r: ledger.effective(spark.createDataFrame(r, "i string, count_kind string, n long, credited long, t long"), ["i"], [F.col("t")])
    assert [make(rows[:k]).first().effect for k in (1, 2, 3, 4)] == [18, 20, 23, 23]
    assert ledger.effect_of(make(rows[:2]), make(rows[:3]), ["i"]).first().change == 3
    assert make([*rows, ("i", "delta", 2, 5, 9)]).first().effect == 20


def test_strict_inputs(spark):
    base = spark.createDataFrame([("2026-01", 1), ("2026-13", 2), ("2026-02", -1), ("2026-03", 1), ("2026-03", 1)], "month string, deaths int")
    assert sorted(r.reason for r in ledger.baseline_violations(base).collect()) == ["bad count", "bad month", "month twice", "month twice"]
    with pytest.raises(ledger.Violations):
        ledger.require_none(ledger.baseline_violations(base), "baseline")
    ledger.require_none(ledger.baseline_violations(base.limit(0)), "baseline")


def test_negative_months_are_not_published(spark):
    base = spark.createDataFrame([("2026-01", 1), ("2026-02", 7)], "month string, deaths long")
    less = spark.createDataFrame([("2026-01", "confirmed", -5), ("2026-02", "confirmed", -5)], "month string, status string, deaths_delta long")
    with pytest.raises(ledger.Violations):
        ledger.published_monthly(base, less)
    assert ledger.published_monthly(base, less.where("month = '2026-02'")).where("month = '2026-02'").first().total == 2


def test_promotion_is_a_no_op_the_second_time(spark):
    candidates = spark.createDataFrame([("c1", "r1", 3), ("c2", "r2", 4), ("c3", "r3", 5)], "candidate_id string, record_id string, n long")
    old = spark.createDataFrame([("r2", 4, ["x"]), ("r3", 6, ["y"])], "record_id string, n long, candidate_ids array<string>")
    done = ledger.promoted(candidates, old, ["n"])
    assert {r.candidate_id: r.action for r in done.collect()} == {"c1": "insert", "c2": "link", "c3": "conflict"}
    after = done.where("action <> 'conflict'").select("record_id", "n", "candidate_ids")
    assert {r.action for r in ledger.promoted(candidates.where("record_id <> 'r3'"), after, ["n"]).collect()} == {"none"}


def test_reviews(spark):
    c = spark.createDataFrame([("a", "sumy", "needs_review"), ("b", "sumy", "confirmed")], "candidate_id string, city_key string, status string")
    d = spark.createDataFrame([("a", "sumy", "hold", 1), ("a", "kyiv", "hold", 1), ("b", "sumy", "hold", 1), ("z", "sumy", "hold", 1)], "candidate_id string, city_key string, to_status string, at long")
    assert sorted((r.candidate_id, r.city_key, r.accepted) for r in ledger.reviewed(c, d).collect()) == [("a", "kyiv", False), ("a", "sumy", True), ("b", "sumy", False), ("z", "sumy", False)]


def test_observation_classes(spark):
    rows = spark.createDataFrame([("x", 1, "p", "c"), ("x", 2, "p", "c"), ("x", 3, "p", "d"), ("x", 4, "q", "c"), ("y", 5, "p", "c")], "id string, t long, payload string, context string")
    assert [r["class"] for r in observations.classed(rows, ["id"], ["t"]).orderBy("t").collect()] == ["FIRST", "EXACT", "EQUIVALENT", "CONFLICT", "FIRST"]


def marks(spark, rows):
    return spark.createDataFrame(rows, "key string, ts_us long, kind string")


def test_pairs(spark):
    rows = [("a", 1, "start"), ("a", 2, "start"), ("a", 5, "end"), ("a", 6, "end"), ("a", 7, "start"), ("a", 9, "end"), ("a", 9, "start"), ("a", 12, "end"), ("a", 20, "start")]
    assert sorted((r.start_us, r.end_us) for r in ingest.paired(marks(spark, rows), ["key"]).collect()) == [(1, 5), (7, 9), (9, 12)]


def test_upsert_and_continuity(spark):
    make = lambda r: spark.createDataFrame(r, "region string, start_us long, end_us long, fetched_us long")
    once = ingest.upserted(make([("a", 1, 5, 10)]), make([("a", 1, 6, 20), ("b", 1, 2, 20)]), ["region", "start_us"])
    assert sorted(tuple(r) for r in once.select("region", "end_us", "fetched_us", "first_fetched_us").collect()) == [("a", 6, 20, 10), ("b", 2, 20, 20)]
    again = ingest.upserted(once, make([("a", 1, 6, 20)]), ["region", "start_us"])
    assert sorted(map(tuple, again.select(*once.columns).collect())) == sorted(map(tuple, once.collect()))
    targets = spark.createDataFrame([("a", 3), ("b", 0), ("c", 1)], "region string, cutoff_us long")
    state = ingest.continuity(targets, make([("a", 1, 6, 1), ("b", 1, 2, 1)]))
    assert {r.region: r.reason for r in state.collect()} == {"a": "history_overlaps_upstream", "b": "history_window_does_not_reach_upstream", "c": "region_missing_from_history_payload"}
    assert [r.region for r in ingest.bridged(make([("a", 1, 3, 1), ("a", 2, 4, 1), ("b", 1, 9, 1)]), state).collect()] == ["a"]


def test_receipts_bootstrap_then_overlap(spark):
    rows = lambda first, check: spark.createDataFrame([("k", "s", first, check), ("k", "s", None, check + 1)], "key string, source string, start_us long, captured_us long")
    none = spark.createDataFrame([], "key string, source string, checked_us long")
    first = ingest.receipts(rows(5, 10), none).first()
    assert (first.continuous, first.next_us) == (False, 10)
    before = spark.createDataFrame([("k", "s", 10)], "key string, source string, checked_us long")
    assert tuple(ingest.receipts(rows(8, 20), before).select("continuous", "next_us").first()) == (True, 20)
    assert tuple(ingest.receipts(rows(12, 20), before).select("continuous", "next_us").first()) == (False, 10)
    assert tuple(ingest.receipts(rows(None, 20), before).select("continuous", "next_us").first()) == (False, 10)


def test_fingerprint_is_order_free_and_sensitive(spark):
    rows = spark.createDataFrame([("c", i) for i in range(50)], "city string, n long")
    one = proofs.fingerprint(rows, ["city"]).first()
    assert one == proofs.fingerprint(rows.orderBy(F.desc("n")), ["city"]).first()
    assert one.digest != proofs.fingerprint(rows.where("n <> 7"), ["city"]).first().digest
    text = "".join(f"{h}:1;" for h in sorted(hashlib.sha256(json.dumps({"city": "c", "n": i}, separators=(",", ":")).encode()).hexdigest() for i in range(50)))
    assert one.digest == hashlib.sha256(text.encode()).hexdigest() and one.n == 50


def test_digest_trees(spark):
    """Deep enough for leaves of bounded size, also with a row that is a third of all; changes are found from the root down."""
    rows = spark.range(9000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("v"))
    assert [proofs.tree_depth(n) for n in (0, 256, 257, 4096, 4097)] == [0, 0, 1, 1, 2]
    hashed = proofs.row_hashes(rows, ["k"])
    levels = proofs.digest_tree(hashed, ["k"], 2)
    leaves = hashed.groupBy("k", F.substring("h", 1, 2)).count()
    assert len(levels) == 3 and leaves.agg(F.max("count")).first()[0] < 2 * proofs.LEAF and levels[0].agg(F.sum("n")).first()[0] == 9000
    assert levels[1].count() == 32 and levels[2].count() == 512
    after = rows.where("v <> 7").unionByName(rows.where("v = 8")).unionByName(spark.createDataFrame([(0, 10**7), (5, 1)], "k long, v long")).repartition(5)
    found = {(r.k, r.before, r.after) for r in proofs.changed_rows(rows, after, ["k"]).collect()}
    assert found == {(1, 1, 0), (0, 1, 2), (0, 0, 1), (5, 0, 1)}
    ranges = proofs.changed_ranges(levels, proofs.digest_tree(proofs.row_hashes(after, ["k"]), ["k"], 2), ["k"])
    assert ranges.count() == 4
    assert proofs.changed_rows(rows, rows.repartition(7), ["k"]).count() == 0 and proofs.changed_rows(rows.limit(0), rows.limit(0), ["k"]).count() == 0


def test_row_text(spark):
    rows = spark.createDataFrame([(1, "ї=;", 2.5, True, [0.1, None], None)], "b long, a string, c double, d boolean, e array<double>, f string")
    assert rows.select(proofs.row_text(rows)).first()[0] == "a=4:ї=;;b=1:1;c=7:2500000;d=1:1;e=7:100000,;f=;"


def test_freshness_reasons(spark):
    rows = spark.createDataFrame([("a", 100, True), ("b", None, True), ("c", 100, False), ("d", 300, True), ("e", 0, True)], "key string, checked_us long, continuous boolean")
    found = {r.key: r.reasons for r in proofs.freshness(rows, F.lit(200), 150).collect()}
    assert found == {"a": [], "b": ["missing"], "c": ["not continuous"], "d": ["from the future"], "e": ["too old"]}


def test_eligibility_includes_the_cutoff(spark):
    assert snapshot.eligible(spark.createDataFrame([(1,), (2,), (3,)], "end_us long"), F.lit(2)).count() == 2


def test_sources(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps([{"type": "T", "dateTimeStart": "2026-09-09T23:23:00", "dateTimeEnd": "2026-09-10T00:12:00"}, {"type": "X", "dateTimeStart": "2026-09-09T23:23:00", "dateTimeEnd": "2026-09-10T00:12:00"}, {"type": "T", "dateTimeStart": "bad"}]))
    one = histories.municipal(spark, str(tmp_path / "m.json"), "T").collect()
    assert [(r.end_us - r.start_us) // 60_000_000 for r in one] == [49]
    (tmp_path / "n.csv").write_text("﻿oblast,raion,hromada,level,started_at,finished_at\nO,R,,raion,2026-01-01T00:00:00Z,2026-01-01T01:00:00Z\nO,R,,raion,2026-01-01T01:00:00Z,2026-01-01T01:00:00Z\n")
    rows = histories.national(spark, str(tmp_path / "n.csv"))
    assert [(r.oblast, r.raion) for r in rows.collect()] == [("O", "R")]
    dim = spark.createDataFrame([("raion", "O", "R", None, "city", 0)], "level string, oblast string, raion string, hromada string, key string, valid_from_us long")
    assert histories.by_region(rows.union(rows), dim).count() == 1
    assert histories.primary_or_fallback(rows.limit(0), rows).first().mode == "fallback"


def test_history_page_over_midnight(spark):
    html = "<table><tr><td>00:12 10.09.26</td><td>🟢 Відбій тривоги</td><td>49 хв</td></tr><tr><td>23:23 09.09.26</td><td>🔴 Повітряна тривога!</td></tr></table>"
    found = ingest.paired(pages.history_marks(spark.createDataFrame([("k", html)], "key string, html string")), ["key"]).first()
    assert (found.end_us - found.start_us) // 60_000_000 == 49 and times.SECOND
    body = base64.b64encode(html.encode()).decode()
    rows = spark.createDataFrame([("k", "page", body, hashlib.sha256(html.encode()).hexdigest())], "city string, source_key string, body_base64 string, body_sha256 string")
    captured = histories.capture_pages(rows)
    assert captured.first().intact and histories.replayed(captured).count() == 1


def test_links_and_articles(spark):
    html = '<title>A &amp; B</title><script>x</script><a href="/p#f">One <b>two</b></a><a href="mailto:x">no</a><p>Text</p>'
    rows = spark.createDataFrame([(1, "https://Ex.org/a/b?c", html)], "page_id long, url string, html string")
    assert [tuple(r) for r in pages.links(rows).collect()] == [(1, "ex.org", "https://Ex.org/p", "One two")]
    one = pages.articles(rows).first()
    assert one.title == "A & B" and one.digest == hashlib.sha256(b"A & B One two no Text").hexdigest()
    feed = spark.createDataFrame([(1, "<rss><item><title>T</title><link>https://e.org/x#y</link></item></rss>")], "feed_id int, body string")
    assert [tuple(r) for r in pages.feed_items(feed).collect()] == [(1, "T", "https://e.org/x")]


def test_text_extraction(spark):
    texts = ["Унаслідок обстрілу Києва загиблих щонайменше 12, 3 людини загинули 9 травня та 10 ЧЕРВНЯ 2024 року; 999 загиблих", "killed 3 people on 9 may"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select(words.counts_near(F.col("t")), words.dates_in(F.col("t"), F.lit(2026)), words.relevant(F.col("t"))).collect()
    assert [(r[0], [str(d) for d in r[1]], r[2]) for r in found] == [([3, 12], ["2024-06-10", "2026-05-09"], True), ([], [], False)]
    assert rows.select(words.name_key(F.lit("  Кам’янець  A"))).first()[0] == "кам'янець a"
    secret = rows.select(words.masked(F.lit("url?token=abc&x, API_KEY: zz; Authorization: Bearer q.w.e tokens")), words.masked(F.lit(None).cast("string"))).first()
    assert secret[0] == "url?token=***, API_KEY: ***; Authorization: Bearer *** tokens" and secret[1] is None
    pair = spark.createDataFrame([(None, 1)], "a string, b int").select(words.canonical_hash(F.col("a"), F.col("b")), words.canonical_hash(F.col("b"))).first()
    assert pair[0] != pair[1]


def test_revision_rules(spark):
    rows = [("a", "confirmed", "2026-01-02", "3"), ("b", " Needs_Review ", "2026-01-02", ""), ("c", "pending", "2026-01-02", None), ("d", "rejected", "2026-02-30", "1"), ("", "x", "x", "x"), (" e ", "confirmed", "2026-01-02", "1.5"), ("e", "confirmed", "2026-01-02", "-1")]
    found = ledger.revision_violations(spark.createDataFrame(rows, "record_id string, status string, attack_date string, deaths_delta string"))
    assert sorted(map(tuple, found.collect())) == [("c", "bad status"), ("d", "bad date"), ("e", "bad count"), ("e", "id twice"), ("e", "id twice")]


def test_control_years_of_either_side(spark):
    monthly = spark.createDataFrame([("2022-02", 3), ("2022-03", 4), ("2023-01", 1)], "month string, deaths long")
    want = spark.createDataFrame([("2022", 7), ("2023", 2), ("2024", 5)], "year string, expected long")
    assert sorted(tuple(r) for r in ledger.control_totals(monthly, want).collect()) == [("2023", 1, 2), ("2024", None, 5)]


def test_confirmation_rules(spark):
    good = {"record_id": "r", "attack_date": "2026-05-01", "deaths_delta": "2", "source_name": "n", "source_url": "https://e.org/x", "incident_id": "incident:2026-05-01:kyiv", "count_kind": "cumulative",
            "baseline_credited": "0", "identity_proof": "sha256:" + "0" * 64, "credited_proof": "git:" + "f" * 40 + ":data/x.csv"}
    bad = {"record_id": " ", "attack_date": "1.5.2026", "deaths_delta": "0", "source_name": None, "source_url": "ftp://e.org", "incident_id": "2026", "count_kind": "total", "baseline_credited": "00", "identity_proof": "sha256:1", "credited_proof": "git:main:x"}
    rows = [good, *({**good, k: v} for k, v in bad.items()), bad]
    schema = ", ".join(f"{k} string" for k in good)
    found = [r.reasons for r in ledger.confirmation_reasons(spark.createDataFrame([tuple(r.values()) for r in rows], schema)).collect()]
    names = ["no id", "bad date", "bad count", "no source", "bad address", "bad incident", "bad kind", "bad credit", "no identity", "no credit proof"]
    assert found == [[], *[[n] for n in names], names]


def test_review_history_grows(spark):
    c = spark.createDataFrame([("a", "x", "needs_review", None), ("b", "x", "needs_review", [(1, "new", "needs_review")])], "candidate_id string, city_key string, status string, review_history array<struct<at:long,from:string,to:string>>")
    d = spark.createDataFrame([("a", "x", "hold", 5), ("b", "x", "new", 6)], "candidate_id string, city_key string, to_status string, at long")
    after = {r.candidate_id: (r.status, [tuple(s) for s in r.review_history]) for r in ledger.reviewed_history(c, ledger.reviewed(c, d)).collect()}
    assert after == {"a": ("hold", [(5, "needs_review", "hold")]), "b": ("needs_review", [(1, "new", "needs_review")])}


def test_accepted_names(spark):
    rows = [(1, "Київ", "м. Київ", ""), (2, "Київ", "м. Київ", None), (3, "Київ", "м. Київ", " київ "), (4, "Київ", "м. Київ", "М. КИЇВ"), (5, "Київ", "м. Київ", "Kyiv"), (6, "Київ", "м. Київ", "Львів"), (7, "Київ", "", "")]
    df = spark.createDataFrame(rows, "id long, region string, group_name string, name string")
    aliases = spark.createDataFrame([("Київ", "KYIV"), ("Львів", "Lviv")], "region string, name string")
    assert sorted(r.id for r in ingest.accepted_names(df, aliases).collect()) == [1, 2, 3, 4, 5, 7]


def test_empty_history_is_not_missing(spark):
    targets = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5)], "region string, cutoff_us long")
    polled = spark.createDataFrame([("a", 1, 3, "AIR"), ("a", 4, 99, "OTHER"), ("a", 6, 6, "air")], "region string, start_us long, end_us long, kind string")
    found = {r.region: (r.reason, r.latest_us, r.history_n, r.completed_n) for r in ingest.continuity(targets, polled, spark.createDataFrame([("a",), ("b",)], "region string")).collect()}
    assert found == {"a": (ingest.REASONS["reached"], 3, 3, 1), "b": (ingest.REASONS["short"], None, 0, 0), "c": (ingest.REASONS["missing"], None, 0, 0)}


def test_best_match(spark):
    names = spark.createDataFrame([("o", "Біла Церква"), ("o", "Бар"), ("o", "Суми"), ("p", "Суми")], "oblast string, name string")
    have = [("o", "м. Біла Церква"), ("o", "м. Біла Церква та інші"), ("o", "м. Барвінкове"), ("o", "Барська громада"), ("o", "БАР-селищна"), ("p", "Сумська")]
    found = {(r.oblast, r.name): (r.candidate, r.score) for r in coverage.best_match(names, spark.createDataFrame(have, "oblast string, name string"), ["oblast"]).collect()}
    assert found == {("o", "Біла Церква"): ("м. Біла Церква та інші", 100), ("o", "Бар"): ("м. Барвінкове", 50)}


def test_versioned_table_and_snapshot(spark, tmp_path):
    table = sinks.VersionedTable(spark, f"file://{tmp_path}/t", keep=2)
    assert table.current() is None
    assert [table.replace(spark.range(2)), table.replace(spark.range(4))] == [0, 1]
    # a stream's epochs are not versions
    assert table.replace(spark.range(7), 0, "s") == 2 and table.current().count() == 7
    assert table.replace(spark.range(9), 0, "s") == 2 and table.current().count() == 7
    assert table.replace(spark.range(8), 0, "t") == 3 and table.current().count() == 8
    assert table.replace(spark.range(5), 1, "s") == 4 and table.replace(spark.range(6)) == 5
    assert table.replace(spark.range(9), 0, "t") == 3  # known although its data are gone
    with pytest.raises(ValueError):
        table.replace(spark.range(1), 0, "s")
    assert sorted(p.name for p in (tmp_path / "t/data").iterdir()) == ["4", "5"]
    told = sinks.snapshot({"a": spark.range(5)}, f"file://{tmp_path}/s").first()
    assert (told["name"], told.n, len(told.sha256)) == ("a", 5, 64)
    assert told.sha256 == proofs.manifest({"a": spark.range(5).repartition(3)}).first().sha256 != proofs.manifest({"a": spark.range(1, 6)}).first().sha256
    text = sinks.document({"g": (spark.range(3).select("id", (F.col("id") * 2).alias("v")), ["id"])}).first().document
    assert json.loads(text) == {"g": [{"id": i, "v": 2 * i} for i in range(3)]}


def run_stream(frame, into, checkpoint):
    run = frame.writeStream.foreachBatch(into).option("checkpointLocation", f"file://{checkpoint}").start()
    run.processAllAvailable()
    run.stop()


def test_streams_lose_no_batches(spark, tmp_path):
    """Into a table with batch versions, and again with a new checkpoint."""
    source = f"file://{tmp_path}/in"
    spark.createDataFrame([("a", 1), ("b", 2)], "key string, fetched_us long").write.mode("append").parquet(source)
    stream = spark.readStream.schema("key string, fetched_us long").parquet(source)
    table = sinks.VersionedTable(spark, f"file://{tmp_path}/table")
    first = spark.createDataFrame([("z", 9, 9)], "key string, fetched_us long, first_fetched_us long")
    table.replace(first), table.replace(first)
    run_stream(stream, polls.upsert_into(table, ["key"]), tmp_path / "c1")
    assert {r.key for r in table.current().collect()} == {"a", "b", "z"}
    spark.createDataFrame([("c", 3)], "key string, fetched_us long").write.mode("append").parquet(source)
    run_stream(stream, polls.upsert_into(table, ["key"]), tmp_path / "c1")
    assert {r.key for r in table.current().collect()} == {"a", "b", "c", "z"}
    spark.createDataFrame([("d", 4)], "key string, fetched_us long").write.mode("append").parquet(source)
    run_stream(stream, polls.upsert_into(table, ["key"]), tmp_path / "c2")
    assert {r.key: r.fetched_us for r in table.current().collect()} == {"a": 1, "b": 2, "c": 3, "d": 4, "z": 9}


def test_parents_and_receipts_as_streams(spark, tmp_path):
    for name in ("rows", "captures"):
        (tmp_path / name).mkdir()
    source = f"file://{tmp_path}/rows"
    schema = "kind string, k long, v long, at_us long"
    stream = spark.readStream.schema(schema).parquet(source)
    hour = 3_600_000_000
    batches = [("parent", 1, 0, 0), ("child", 1, 5, 1), ("child", 2, 6, 1), ("child", 3, 8, 2 * hour)], [("parent", 2, 0, 3), ("child", 2, 7, 4), ("parent", 1, 0, 5)], [("child", 3, 9, 90 * hour)], [("parent", 3, 0, 91 * hour)]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        table = sinks.KeyedTable(spark, f"file://{tmp_path}/family", ["k"], buckets=8)  # each batch after a restart
        run_stream(stream, polls.parents_first(table), tmp_path / "c3")
        placed = sorted((r.k, r.v) for r in table.current().where("kind = 'child'").collect())
        late = sorted((r.k, r.v, r.overdue) for r in polls.waiting(table, F.lit(92 * hour)).collect())
        want = {0: ([(1, 5)], [(2, 6, True), (3, 8, True)]), 1: ([(1, 5), (2, 6), (2, 7)], [(3, 8, True)]), 2: ([(1, 5), (2, 6), (2, 7)], [(3, 8, True), (3, 9, False)]), 3: ([(1, 5), (2, 6), (2, 7), (3, 8), (3, 9)], [])}
        assert (placed, late) == want[batches.index(rows)]
    assert sorted(r.k for r in table.current().where("kind = 'parent'").collect()) == [1, 2, 3]
    source = f"file://{tmp_path}/captures"
    schema = "key string, source string, start_us long, captured_us long"
    stream = spark.readStream.schema(schema).parquet(source)
    checks, told = (sinks.VersionedTable(spark, f"file://{tmp_path}/{n}") for n in ("checks", "told"))
    seen = []
    for row in (("k", "s", 5, 10), ("k", "s", 8, 20), ("k", "s", 25, 30)):
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(source)
        run_stream(stream, polls.receipts_into(checks, told), tmp_path / "c4")
        seen.append((told.current().first().continuous, checks.current().first().checked_us))
    assert seen == [(False, 10), (True, 20), (False, 20)]


def test_keyed_table_writes_what_a_batch_touches(spark, tmp_path):
    table = sinks.KeyedTable(spark, f"file://{tmp_path}/t", ["key"], buckets=64, keep=2)
    upsert = lambda rows, epoch: polls.upsert_into(table, ["key"])(rows, epoch)
    size = lambda: sum(p.stat().st_size for p in (tmp_path / "t/data").rglob("*.parquet"))
    polled = lambda ids, at: spark.range(*ids).select(F.concat(F.lit("k"), "id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(at).cast("long").alias("fetched_us"))
    upsert(polled((0, 20_000), 1), 0)
    whole = size()
    for epoch, ids in enumerate([(5, 7), (19_999, 20_003), (5, 6)], 1):
        before = size()
        upsert(polled(ids, epoch + 1), epoch)
        upsert(polled(ids, 99), epoch)  # a repeated epoch does nothing
        assert size() - before < whole * (ids[1] - ids[0] + 1) / 64
    found = {r.key: (r.fetched_us, r.first_fetched_us) for r in table.current().collect()}
    assert len(found) == 20_003 and found["k5"] == (4, 1) and found["k6"] == (2, 1) and found["k20002"] == (3, 3) and found["k0"] == (1, 1)
    assert len(list((tmp_path / "t/lists").glob("*.json"))) == 2
    listed = table._listed(3)
    assert len(listed) == 64 and {v for v in listed.values()} == {0, 1, 2, 3}


def test_regions_by_left_out_columns(spark):
    rows = [("raion", "O", "R", None, 1, 2), ("hromada", "O", "R", "H", 3, 4), ("hromada", "O", "Q", "H", 5, 6), ("oblast", "O", None, None, 7, 8)]
    dim = [("raion", "O", "R", None, "a", 0), ("hromada", None, None, "H", "b", None), ("hromada", "O", "R", "H", "c", 0), ("oblast", "O", None, None, "d", 9), ("oblast", None, None, None, "e", 0)]
    found = histories.by_region(spark.createDataFrame(rows, "level string, oblast string, raion string, hromada string, start_us long, end_us long"),
                                spark.createDataFrame(dim, "level string, oblast string, raion string, hromada string, key string, valid_from_us long"))
    assert sorted((r.key, r.start_us) for r in found.collect()) == [("a", 1), ("b", 3), ("b", 5), ("c", 3), ("e", 7)]


def test_streams_equal_their_batch_twins(spark, tmp_path):
    rows = [("a", 1, "start"), ("a", 4, "end"), ("b", 2, "start"), ("a", 6, "start"), ("b", 9, "end"), ("a", 8, "end"), ("b", 11, "end")]
    second = 1_000_000
    rows = [(k, t * second, kind) for k, t, kind in rows]
    source = f"file://{tmp_path}/in"
    for part in (rows[:4], rows[4:]):
        df = marks(spark, part).select("key", F.timestamp_micros("ts_us").alias("ts"), "kind", F.col("ts_us").alias("fetched_us"))
        df.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("key string, ts timestamp, kind string, fetched_us long").option("maxFilesPerTrigger", 1).parquet(source)
    run = polls.paired(stream).writeStream.format("memory").queryName("pairs").outputMode("append").option("checkpointLocation", f"file://{tmp_path}/c1").start()
    run.processAllAvailable()
    run.stop()
    found = sorted((r.key, r.start_us, r.end_us) for r in spark.table("pairs").collect() if not r.expired)
    assert found == sorted((r.key, r.start_us, r.end_us) for r in ingest.paired(marks(spark, rows), ["key"]).collect())
    table = sinks.VersionedTable(spark, f"file://{tmp_path}/store")
    run = stream.select("key", "kind", "fetched_us").writeStream.foreachBatch(polls.upsert_into(table, ["key", "kind"])).option("checkpointLocation", f"file://{tmp_path}/c2").start()
    run.processAllAvailable()
    run.stop()
    whole = marks(spark, rows).groupBy("key", "kind").agg(F.max("ts_us"), F.min("ts_us"))
    assert sorted(map(tuple, table.current().select("key", "kind", "fetched_us", "first_fetched_us").collect())) == sorted(map(tuple, whole.collect()))


def test_ledger_files(spark, tmp_path):
    (tmp_path / "b.csv").write_text("\ufeffmonth,deaths,coverage_through,note\n2022-02,2,,\n2022-03,x,,odd\n")
    assert [tuple(r) for r in histories.baseline_file(spark, str(tmp_path / "b.csv")).select("month", "deaths").collect()] == [("2022-02", 2), ("2022-03", None)]
    assert sorted(r.reason for r in ledger.baseline_violations(histories.baseline_file(spark, str(tmp_path / "b.csv"))).collect()) == ["bad count"]
    head = ",".join(histories.REVISIONS)
    (tmp_path / "r.csv").write_text(f"\ufeff{head}\nr1,o, 2026-05-01 ,3,confirmed,n,u,\n,o,bad,x,odd,n,u,\nr2,o,2026-05-01,,needs_review,n,u,\n")
    assert ledger.revision_violations(histories.revision_file(spark, str(tmp_path / "r.csv"))).count() == 0
    (tmp_path / "q.json").write_text(json.dumps([{"candidate_id": "c", "city_key": "sumy", "status": "needs_review", "review_history": [{"at": "t", "from": "a", "to": "b"}]}, {"city_key": "x"}]))
    one = histories.review_queue(spark, str(tmp_path / "q.json")).collect()
    assert [(r.candidate_id, r.review_history[0].to) for r in one] == [("c", "b")]


def test_outputs_and_corpus(spark, tmp_path):
    rows = spark.createDataFrame([(0, 90_000_000, "official")], "start_us long, end_us long, source string")
    sinks.event_file(rows, f"file://{tmp_path}/events")
    assert [tuple(r) for r in spark.read.json(f"file://{tmp_path}/events").select("start", "end", "duration_minutes").collect()] == [("1970-01-01T00:00:00Z", "1970-01-01T00:01:30Z", 1.5)]
    body = json.dumps({"cities": {"sumy": {"count": 2, "episodes": [{"city_key": "sumy", "start_at": "a", "end_at": "b", "episode_state": "closed"}]}, "kyiv": {"count": 0, "episodes": []}}})
    found = histories.corpus(spark.createDataFrame([(body,)], "body string"), "body").collect()
    assert sorted((r.city, r.declared, r.episode_state) for r in found) == [("kyiv", 0, None), ("sumy", 2, "closed")]
    (tmp_path / "batch.json").write_text(json.dumps({"observations": [{"observation_id": "x"}, {"observation_id": "y"}], "episode_results": [{"episode_id": "e", "source_observation_ids": ["x", "z"]}]}))
    seen, told = histories.observation_batches(spark, str(tmp_path / "batch.json"))
    assert [(r.position, r.observation_id) for r in seen.orderBy("position").collect()] == [(0, "x"), (1, "y")] and sorted(r.observation_id for r in told.collect()) == ["x", "z"]
    page = lambda text: spark.createDataFrame([(1, "https://e.org/x", f"<title>T</title><p>{text}</p>")], "page_id long, url string, html string")
    old, new = pages.articles(page("one")), pages.articles(page("two"))
    assert pages.changed(old, new).count() == 1 and pages.changed(old, old).count() == 0


def test_captures_are_read_by_source(spark, tmp_path):
    """A reader that asks for one kind of source opens its folder only; bodies that were changed are told."""
    pages_ = [("history", "7", "u1", b'{"regionId":"7","alarms":[{"alertType":"AIR","startDate":"2024-01-01T00:00:00Z","endDate":"2024-01-01T01:00:00Z"}]}'), ("page", "c", "u2", "<li>08:05 01.02.24 Повітряна тривога</li><li>10:07 01.02.24 Відбій</li>".encode()), ("page", "d", "u3", b"<li></li>")]
    rows = spark.createDataFrame(pages_, "source_key string, city string, url string, body binary").selectExpr("*", "'2024-02-01T00:00:00Z' AS started_at", "'2024-02-01T00:00:01Z' AS captured_at")
    captures.write(captures.bundled(rows, ["source_key", "city"]), f"file://{tmp_path}/b")
    one = captures.read(spark, f"file://{tmp_path}/b", ["page"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "source_key" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r.city for r in one.collect()} == {"c", "d"}
    every = histories.capture_pages(captures.read(spark, f"file://{tmp_path}/b"))
    assert every.where("intact").count() == 3
    assert histories.capture_pages(captures.read(spark, f"file://{tmp_path}/b").withColumn("body_sha256", F.lit("0"))).where("intact").count() == 0
    found = {(r.key, r.start_us, r.end_us) for r in histories.replayed(every).collect()}
    assert len(found) == 2 and {k for k, *_ in found} == {"7", "c"} and all(b - a in (3_600_000_000, 122 * 60_000_000) for _, a, b in found)


def test_digest_tree_levels_are_made_from_the_kept_one_below(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("k"), "id")
    hashed = proofs.row_hashes(rows, ["k"])
    kept = []

    def keep(level):
        kept.append(spark.createDataFrame(level.collect(), level.schema))
        return kept[-1]

    levels = proofs.digest_tree(hashed, ["k"], 2, keep)
    assert levels == kept[::-1] and len(kept) == 3
    for a, b in zip(levels, proofs.digest_tree(hashed, ["k"], 2), strict=True):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    after = rows.where("id <> 7").unionByName(rows.where("id = 9")).withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    before = rows.withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    assert sorted((r.k or 0, r.before, r.after) for r in proofs.changed_rows(before, after, ["k"]).collect()) == [(0, 1, 2), (1, 1, 0)]


def test_titles_of_links_are_made_once(spark):
    rows = spark.createDataFrame([(1, "https://a.org/x", '<a href="/1"><b>Удар</b> по Києву, є загиблі</a><a href="/2">Удар</a><a href="mailto:x">Удар, Київ, загинув</a>')], "page_id long, url string, html string")
    found = pages.links(rows, ["a.org"], relevant=True)
    assert [tuple(r) for r in found.collect()] == [(1, "a.org", "https://a.org/1", "Удар по Києву, є загиблі")]
    assert str(found._jdf.queryExecution().optimizedPlan()).count("regexp_replace") < 12


def test_violations_of_a_frequent_id_are_counted_where_they_are(spark):
    rows = spark.range(10_000).select(F.lit(" a ").alias("record_id"), F.when(F.col("id") < 9000, "confirmed").otherwise("x").alias("status"), F.lit("2026-01-02").alias("attack_date"), F.lit("1").alias("deaths_delta"))
    counted = ledger.counted_violations(rows)
    assert sorted(map(tuple, counted.collect())) == [("a", "bad status", 1000), ("a", "id twice", 10_000)]
    assert "Window" not in str(counted._jdf.queryExecution().optimizedPlan())
    each = ledger.revision_violations(rows)
    assert sorted(map(tuple, each.groupBy("record_id", "reason").count().collect())) == sorted(map(tuple, counted.collect()))


def test_batch_files_lie_in_one_folder(spark):
    from pathlib import Path

    from spanloom.plans import file_queries

    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(shared.iterdir())
    file_queries.batch_references(spark, "/root/testdata/sf0.001").count()
    made = [f for d in set(shared.iterdir()) - before for f in d.iterdir()]
    assert made and not any(f.is_dir() for f in made)

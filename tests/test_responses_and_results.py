import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from clauseloom.fields import BOOLEAN, SLA_FIELDS, Field, names, result_schema
from clauseloom.operators import responses as rp
from clauseloom.plans import inspection as ins
from clauseloom.plans import statistics as stats
from clauseloom.sources import contracts as ct
from clauseloom.sources import results as rs
from clauseloom.sources import snapshots as sn
from verification import fixture as fx

from conftest import values

FIELDS = (Field("a"), Field("b"), Field("flag", kind=BOOLEAN))
AT = dt.datetime(2024, 1, 1)


def judged(spark, *raws):
    rows = [(str(i), f"f{i}", raw, 10, AT) for i, raw in enumerate(raws)]
    df = spark.createDataFrame(rows, "contract_id string, file_path string, raw_response string, tokens_used long, created_at timestamp_ntz")
    return {r["contract_id"]: r for r in rp.validate(rp.parse(df), FIELDS).collect()}


@pytest.mark.parametrize("raw, status, populated", [
    ('{"a":"1","b":"2"}', "success", 2), ('{"a":"1"}', "partial", 1), ('{"a":"1","flag":false}', "success", 2),
    ('{"a":"","other":3}', "success", 2), ('{"a":null}', "partial", 0), ("{}", "partial", 0),
    ('```json\n{"a":"1"}\n```', "partial", 1), ('```{"a":"1"}\n```', "partial", 1), ('  {"a":"1"}\n', "partial", 1),
    ('x {"a":"1"} y', "partial", 1), ('{"a":"1"} tail', "partial", 1), ('{"a":"1"} tail }', "failed", None),
    ("[1", "failed", None), ("[1]", "failed", None), ('"text"', "failed", None), ("", "failed", None), (None, "failed", None),
    ('```json\n{"a":"1",\n"b":"2"}', "failed", None), ('{"a":5}', "failed", None), ('{"a":["x"]}', "failed", None),
    ('{"flag":"true","a":"1"}', "success", 2), ('{"flag":"Yes","a":"1"}', "success", 2), ('{"flag":1}', "partial", 1),
    ('{"a":"1","a":"2"}', "partial", 1), ('x {"a":"1","a":"2","b":"3"} y', "success", 2), ('[{"a":"1","a":"2"}]', "failed", None),
    ('{"a":5,"a":"x"}', "partial", 1), ('{"a":"x","a":5}', "failed", None), ("{'a':'1','a':'2'}", "failed", None), ('{"a":"1","a":null,"b":"2"}', "partial", 1),
    ('{"a":"1","a":"2"},"end":{"b":"2"}', "failed", None), ('{"a":"1","a":"2"', "failed", None),
    ('{"flag":"maybe"}', "failed", None), ('{"a":"1"},"end":{"b":"2"}', "failed", None),
])
def test_parse_and_validate(spark, raw, status, populated):
    row = judged(spark, raw)["0"]
    assert (row["status"], row["populated"]) == (status, populated)
    if status == "failed":
        assert row["tokens_used"] == 0 and row["error"] and row["raw_response"] is None and row["a"] is None
    else:
        assert row["tokens_used"] == 10 and row["error"] is None


def test_values_are_typed(spark):
    row = judged(spark, '{"a":"x \\"q\\" y","b":null,"flag":"false"}')["0"]
    assert (row["a"], row["b"], row["flag"]) == ('x "q" y', None, False)


def test_the_last_of_equal_keys_counts(spark):
    row = judged(spark, 'so: {"a":"1","b":"{\\"a\\":0}","flag":false,"a":"2","flag":true}')["0"]
    assert (row["a"], row["b"], row["flag"]) == ("2", '{"a":0}', True)


def test_fixture_status_counts(spark):
    counts = dict(values(stats.status_counts(fx.results(spark, "/root/testdata/sf0.01"))))
    assert counts == {"success": 749, "partial": 172, "failed": 58}


def test_eighteen_fields_in_a_table_of_25_columns():
    assert len(SLA_FIELDS) == 18 and len(result_schema().names) == 25


def rows(spark, *items):
    return spark.createDataFrame([(c, s, t) for c, s, t in items], "contract_id string, status string, created_at timestamp_ntz")


def test_upsert_keeps_one_newest_row(spark):
    later = AT + dt.timedelta(hours=1)
    old = rows(spark, ("a", "old", AT), ("b", "old", AT))
    new = rows(spark, ("a", "first", later), ("a", "second", later), ("c", "new", AT))
    new = new.withColumn("seq", F.when(F.col("status") == "second", 2).otherwise(1))
    assert sorted(values(rs.upsert(old, new, "seq"), "contract_id", "status")) == [("a", "second"), ("b", "old"), ("c", "new")]


def test_table_batches_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not rs.exists(spark, path)
    rs.create(spark, path, fx.FIELDS)
    results = fx.results(spark, "/root/testdata/sf0.001")
    for _ in range(2):
        rs.append_batch(results, path, "run", 4)
    rs.create(spark, path, fx.FIELDS)
    assert rs.exists(spark, path) and rs.read_latest(spark, path, fx.FIELDS).count() == results.count()
    rs.compact(spark, path, str(tmp_path / "u"), fx.FIELDS)
    assert rs.read_latest(spark, str(tmp_path / "u"), fx.FIELDS).count() == results.count()


def snapshot_rows(spark, *items):
    blank = {f.name: None for f in result_schema(fx.FIELDS)}
    made = [{**blank, "contract_id": c, "status": s, "created_at": AT + dt.timedelta(hours=h)} for c, s, h in items]
    return spark.createDataFrame(made, result_schema(fx.FIELDS))


def snapshot(spark, path, **kwargs):
    return dict(values(sn.read(spark, path, fx.FIELDS, **kwargs), "contract_id", "status"))


def test_snapshots_keep_the_newest_row(spark, tmp_path):
    path = str(tmp_path / "t")
    sn.create(spark, path, 8, fx.FIELDS)
    assert snapshot(spark, path) == {}
    assert sn.merge(snapshot_rows(spark, ("a", "one", 1), ("b", "one", 1), ("b", "old", 0)), path, "r", 0, fx.FIELDS) == 1
    files = sn.manifest(spark, path)["files"]
    assert sn.merge(snapshot_rows(spark, ("a", "two", 1), ("c", "two", 1)), path, "r", 1, fx.FIELDS) == 2
    assert sn.merge(snapshot_rows(spark, ("a", "late", 0), ("b", "three", 2)), path, "r", 2, fx.FIELDS) == 3
    assert snapshot(spark, path) == {"a": "two", "b": "three", "c": "two"}
    assert snapshot(spark, path, version=1) == {"a": "one", "b": "one"}
    sn.create(spark, path, 8, fx.FIELDS)
    assert sn.merge(snapshot_rows(spark, ("a", "again", 9)), path, "r", 2, fx.FIELDS) == 3  # that number of the run is stored
    assert sn.merge(snapshot_rows(spark, ("d", "other", 1)), path, "q", 0, fx.FIELDS) == 4
    later = sn.manifest(spark, path)["files"]
    assert sum(later.get(b) == f for b, f in files.items()) == 0 and len(sn.read(spark, path, fx.FIELDS).inputFiles()) == len(later)
    assert values(sn.lookup(spark, path, ["b", "no"], fx.FIELDS), "status") == [("three",)]
    assert len(sn.lookup(spark, path, ["b"], fx.FIELDS).inputFiles()) == 1
    with pytest.raises(ValueError):
        sn.read(spark, path, SLA_FIELDS)


def test_snapshots_leave_untouched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    sn.create(spark, path, 64, fx.FIELDS)
    sn.merge(snapshot_rows(spark, *[(f"c{i}", "one", 0) for i in range(200)]), path, "r", 0, fx.FIELDS)
    before = sn.manifest(spark, path)["files"]
    sn.merge(snapshot_rows(spark, ("c7", "two", 1)), path, "r", 1, fx.FIELDS)
    after = sn.manifest(spark, path)["files"]
    assert sum(before[b] != after[b] for b in before) == 1 and len(snapshot(spark, path)) == 200


def test_a_merge_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sn.create(spark, path, 4, fx.FIELDS)
    sn.merge(snapshot_rows(spark, ("a", "one", 0)), path, "r", 0, fx.FIELDS)

    def dies(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patch:
        patch.setattr(sn, "_commit", dies)
        with pytest.raises(RuntimeError):
            sn.merge(snapshot_rows(spark, ("a", "two", 1)), path, "r", 1, fx.FIELDS)
    assert snapshot(spark, path) == {"a": "one"}
    sn.merge(snapshot_rows(spark, ("a", "three", 1), ("b", "three", 1)), path, "r", 1, fx.FIELDS)
    assert snapshot(spark, path) == {"a": "three", "b": "three"}
    assert sn.vacuum(spark, path) == 2  # what the dead merge wrote, and the first version's bucket
    assert snapshot(spark, path) == {"a": "three", "b": "three"}
    with pytest.raises(ValueError):
        sn.read(spark, path, fx.FIELDS, version=1)


def test_of_two_merges_one_is_first(spark, tmp_path):
    path = str(tmp_path / "t")
    sn.create(spark, path, 4, fx.FIELDS)
    seen = sn.manifest(spark, path)
    sn.merge(snapshot_rows(spark, ("a", "one", 0)), path, "r", 0, fx.FIELDS)
    with pytest.raises(Exception, match="exist"):
        sn._commit(spark, path, {**seen, "version": 1})
    assert snapshot(spark, path) == {"a": "one"}


def test_pending_and_failures(spark, tmp_path):
    docs = spark.createDataFrame([("a", "x" * 150), ("b", "tiny"), ("c", "y" * 150), ("d", "z" * 150)], "contract_id string, text string")
    results = spark.createDataFrame([("a", "success", None), ("c", "failed", "bad")], "contract_id string, status string, error string")
    assert sorted(values(rs.pending(docs, results), "contract_id")) == [("b",), ("d",)]
    assert values(rs.pending(docs, results, 1), "contract_id") == [("b",)]
    log = rs.failure_log(ct.too_short(docs), results)
    assert sorted(values(log)) == [("b", "text too short"), ("c", "bad")]
    path = str(tmp_path / "failures")
    rs.write_failures(log, path)
    assert sorted(values(rs.read_failures(spark, path))) == sorted(values(log))
    assert sorted(values(rs.retry(docs, rs.read_failures(spark, path)), "contract_id")) == [("b",), ("c",)]
    rs.write_failures(log.where("false"), path)
    assert values(rs.read_failures(spark, path)) == []
    assert values(ins.next_candidates(docs, results, 1)) == [("b",)]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a", 'q"uote, é', None, "r", "e")], "contract_id string, v string, n string, raw_response string, error string").coalesce(1)
    rs.export_json_lines(df, str(tmp_path / "j"))
    rs.export_csv(df, str(tmp_path / "c"))
    line = next(p for p in (tmp_path / "j").glob("part-*")).read_text()
    assert "\\u00e9" in line.lower() and json.loads(line)["n"] is None
    assert next(p for p in (tmp_path / "c").glob("part-*")).read_text() == 'contract_id,v,n\na,"q""uote, é",\n'


def test_progress_without_time_span(spark):
    one = spark.createDataFrame([("a", "success", 5, AT)], "contract_id string, status string, tokens_used long, created_at timestamp_ntz")
    assert stats.progress_eta(one).first()["rate_per_sec"] is None
    assert stats.recent_rate(one).count() == 0
    empty = one.where("false")
    assert stats.token_usage(empty).first()["total_tokens"] == 0
    assert stats.field_coverage(empty, ["status"]).first()["percent"] == 0.0


def test_text_order_of_amounts(spark):
    data = [("a", 1, "9"), ("b", 1, "50"), ("c", 1, "1,000"), ("d", 0, "99"), ("e", 1, None)]
    df = spark.createDataFrame(data, "contract_id string, penalty_has_monetary int, penalty_max_amount string").withColumns(
        {"penalty_currency": F.lit("USD"), "penalty_uptime_breach": F.lit("x")})
    assert values(ins.cash_penalties(df), "contract_id") == [("a",), ("b",), ("c",), ("e",)]


def test_field_order():
    assert names(SLA_FIELDS)[0] == "uptime_guarantee" and names(SLA_FIELDS)[-1] == "dispute_resolution"


def test_inspection_marks(spark):
    df = spark.createDataFrame([("a", "0", "", 0)], "contract_id string, a string, b string, flag int")
    assert values(ins.inspect_contract(df, "a", FIELDS), "field", "marker", "preview") == [("a", "Y", "0"), ("b", "-", None), ("flag", "-", None)]

import http.server
import json
import os
import threading
import urllib.parse
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.functions import sessions, symbology
from tidemark.operators import payload, quality, reconcile
from tidemark.sources import vendors
from tidemark.streaming import deliveries

def mapped(symbol, *bars, **more):
    """A payload that maps a symbol to its bars, given as (stamp, open, high, low, close, volume, trades, vwap)."""
    return json.dumps({"bars": {symbol: [dict(zip(("t", "o", "h", "l", "c", "v", "n", "vw"), bar, strict=False)) for bar in bars]}} | more)


def framed(stamps, rows, columns=("Volume", "Stock Splits", "Close", "Low", "High", "Open", "Dividends")):
    return json.dumps({"columns": list(columns), "index": stamps, "data": rows})


ONE = mapped("KQ/A", ("2025-02-14T05:00:00Z", 17.5, 18.125, 16.99995, 17.25, 40960, 512, 17.3333333))
TWO = framed(
    ["2025-06-02T04:00:00Z", "2025-06-03T04:00:00Z", "2025-06-04T04:00:00Z", "2025-06-05T04:00:00Z"],
    [[7.9, 0.0, 31.00004999, 30.0, 32.0, 30.5, 0.0], [8, 4.0, 8.1, 8, 8.2, 8, 0.0], [9, 1.5, 8.3, 8, 8.4, 8, 0.225], [5, None, 8]],
)


def bronze(spark, *responses):
    at, d = datetime(2025, 6, 9, 3), date(2025, 6, 6)
    data = [(i, source, "S", symbol, d, d, "{}", 0, body, 1, at, "night-9") for i, (source, symbol, body) in enumerate(responses)]
    return spark.createDataFrame(
        data,
        "bronze_id long, source string, security_id string, vendor_symbol string, request_start date, request_end date, request_params string,"
        "page int, payload string, record_count int, ingested_at timestamp, run_id string",
    )


def test_payloads(spark, rows):
    frame = bronze(spark, ("alpaca", "KQ/A", ONE), (" Yahoo", "KQ-A", TWO), ("alpaca", "OTHER", ONE), ("yahoo", "x", "{"), ("yahoo", "x", None), ("alpaca", "x", '{"bars":{"x":null}}'))
    delivered = payload.delivered_bars(frame)
    got = {(r["bronze_id"], r["bar_no"]): r for r in delivered.collect()}
    assert sorted(got) == [(0, 0), (1, 0), (1, 1), (1, 2), (1, 3)]
    bar = got[0, 0]
    assert (bar["trade_date"], bar["open"], bar["low"], bar["vwap"], bar["volume"], bar["trade_count"], bar["price_basis"]) == (
        date(2025, 2, 14), Decimal("17.5000"), Decimal("17.0000"), Decimal("17.333333"), 40960, 512, "raw",
    )
    assert (got[1, 0]["close"], got[1, 0]["vwap"], got[1, 0]["price_basis"], got[1, 0]["open"]) == (Decimal("31.0000"), None, "vendor_adjusted", Decimal("30.5000"))
    assert got[1, 0]["volume"] == 7 and got[1, 3]["low"] is None  # a fraction of a frame's volume; a short row
    found = payload.actions(delivered).select("ex_date", "action_type", "value")
    assert rows(found) == sorted([(date(2025, 6, 3), "split", Decimal("4.000000")), (date(2025, 6, 4), "dividend", Decimal("0.225000")), (date(2025, 6, 4), "split", Decimal("1.500000"))], key=repr)
    assert rows(payload.record_counts(frame)) == [(0, 1), (1, 4), (2, 0), (3, 0), (4, 0), (5, 0)]
    assert payload.delivered_bars(bronze(spark)).count() == 0 and payload.record_counts(bronze(spark)).count() == 0


def test_fractions_in_counts_and_missing_columns(spark):
    body = mapped("Z", ("2025-02-14T05:00:00Z", 1, 1, 1, 1, 3.5, 2.5, 1), ("2025-02-17T05:00:00Z", 1e30, 1, 1, 1, 3.0, 2.0, 1))
    first, second = payload.delivered_bars(bronze(spark, ("alpaca", "Z", body))).orderBy("bar_no").collect()
    assert (first["volume"], first["trade_count"]) == (None, None)
    assert (second["open"], second["volume"], second["trade_count"]) == (None, 3, 2)  # a price too large is null as well
    without = framed(["2025-06-02"], [[1.0, 2.0, 3.0, 4.0]], ["Open", "High", "Low", "Volume"])
    with pytest.raises(Exception, match="no column Close"):
        payload.delivered_bars(bronze(spark, ("yahoo", "z", without))).collect()
    bare = framed(["2025-06-02"], [[1.0, 2.0, 3.0, 4.0, 5.0]], ["Open", "High", "Low", "Volume", "Close"])
    assert payload.actions(payload.delivered_bars(bronze(spark, ("yahoo", "z", bare)))).count() == 0


@pytest.mark.parametrize(("stamp", "day"), [("2025-07-15T04:00:00Z", "2025-07-15"), ("2025-12-15T05:00:00Z", "2025-12-15"), ("2025-07-15T03:59:59Z", "2025-07-14"), ("2025-12-15T04:30:00Z", "2025-12-14")])
def test_new_york_dates(spark, stamp, day):
    body = mapped("Z", (stamp, 1, 1, 1, 1, 1, 1, 1))
    assert str(payload.delivered_bars(bronze(spark, ("alpaca", "Z", body))).first()["trade_date"]) == day


def test_unparsed_ranges_and_params(spark, rows):
    frame = bronze(spark, ("alpaca", "a", '{"bars":{}}'), ("alpaca", "a", "{"), ("alpaca", "a", ""), ("yahoo", "a", None), ("yahoo", "a", TWO))
    assert rows(payload.unparsed(frame)) == [("alpaca", "blank", 1), ("alpaca", "empty", 1), ("alpaca", "malformed", 1), ("yahoo", "null", 1)]
    assert payload.overlapping(frame, F.lit(date(2025, 6, 6)), F.lit(date(2025, 6, 9))).count() == 5
    assert payload.overlapping(frame, F.lit(date(2025, 6, 7)), F.lit(date(2025, 6, 9))).count() == 0
    assert spark.range(1).select(payload.request_params(b=F.lit("2"), a=F.lit("1"))).first()[0] == '{"a":"1","b":"2"}'


def test_symbols(spark):
    frame = spark.createDataFrame([(" kq-a\t",), ("KQ/A",), ("KQ A",), ("KQA",), (None,)], "t string")
    assert [r[0] for r in frame.select(symbology.match_key(F.col("t"))).collect()] == ["KQ.A", "KQ.A", "KQ.A", "KQA", None]
    row = spark.range(1).select(
        symbology.to_figi(F.lit("KQ.A")), symbology.from_figi(F.lit("KQ/A")), symbology.to_yahoo(F.lit("KQ.A")), symbology.to_alpaca(F.lit("KQ.A")),
        symbology.issuer_id(F.lit(4711)), symbology.issuer_id(F.lit(98765432101)),
        symbology.spellings_differ(F.lit("A"), F.lit(None), F.lit(""), F.lit("A")), symbology.spellings_differ(F.lit("KQ.A"), F.lit("KQ-A")),
    ).first()
    assert tuple(row) == ("KQ/A", "KQ.A", "KQ-A", "KQ.A", "CIK0000004711", "CIK98765432101", False, True)


def frames(spark, sec=(("KQ.A", "KQ-A", 11), ("VOLT", "VOLT", 22), ("VOLTB", "VOLTB", 22))):
    """Sources of five securities: one spelled in several ways, two of one issuer, one the register doesn't know, one not found."""
    figi = spark.createDataFrame(
        [("s1", "KQ/A", "KQ.A", None), ("s2", "VOLT", "VOLT", None), ("s3", "VOLTB", "VOLTB", None), ("s4", "LOST", "LOST", None), ("s5", None, None, "3 matches")],
        "security_id string, figi_ticker string, exchange_ticker string, figi_error string",
    )
    s = spark.createDataFrame([(k, f"CIK{c}", c, t, "name") for k, t, c in sec], "match_key string, issuer_id string, cik long, sec_ticker string, sec_company_name string")
    yahoo = spark.createDataFrame([("s1", "KQ-A", None), ("s2", None, "slow"), ("s3", None, None)], "security_id string, yfinance_symbol string, yfinance_error string")
    alpaca = spark.createDataFrame([("s1", "KQ.A")], "security_id string, alpaca_symbol string")
    return figi, s, yahoo, alpaca


def test_reconciliation(spark, rows):
    previous = spark.createDataFrame(
        [("s2", "VOLT", "Volt before", "X", "Energy", None, None, None, None), ("s3", "GONE", "Gone", "X", "Energy", None, None, None, None)],
        "security_id string, yfinance_symbol string, yfinance_name string, yfinance_exchange string, yfinance_sector string, alpaca_asset_id string, alpaca_symbol string, alpaca_exchange string, alpaca_tradable boolean",
    )
    resolved, quarantined = reconcile.build_snapshot(*frames(spark), previous)
    got = {r["security_id"]: r for r in resolved.collect()}
    assert sorted(got) == ["s1", "s2", "s3"]
    assert got["s1"]["ticker_mismatch"] and not got["s2"]["ticker_mismatch"]
    assert (got["s2"]["yfinance_symbol"], got["s2"]["yfinance_sector"]) == ("VOLT", "Energy")  # a failed read is carried forward
    assert (got["s3"]["yfinance_symbol"], got["s3"]["yfinance_sector"]) == (None, None)  # a good read overwrites
    assert got["s2"]["issuer_id"] == got["s3"]["issuer_id"]
    assert sorted((r["security_id"], r["quarantine_reason"]) for r in quarantined.collect()) == [("s4", "no SEC match"), ("s5", "OpenFIGI: 3 matches")]
    said = reconcile.report(resolved, quarantined, *frames(spark)[2:])
    assert {name: part.count() for name, part in said.items()} == {"mismatches": 1, "shared": 2, "yfinance_failures": 1, "alpaca_failures": 0, "quarantined": 2}
    assert rows(said["yfinance_failures"]) == [("slow", 1)]
    with pytest.raises(reconcile.FanOut):
        reconcile.build_snapshot(*frames(spark, (("KQ.A", "KQ-A", 11), ("KQ.A", "KQ.A", 12))))


MATCH = '{"figi":"f","compositeFIGI":"%s","ticker":"KQ/A","name":"n","securityType":"odd","securityType2":"Common","shareClassFIGI":"s"}'


def test_source_answers(spark, rows):
    sec = reconcile.sec_tickers(spark.createDataFrame([('{"0":{"cik_str":4711,"ticker":"KQ-A","title":"K"},"1":{"cik_str":8,"ticker":"KQ.A","title":"X"}}',)], "content string"))
    assert rows(sec)[0][:3] == ("KQ.A", "CIK0000000008", 8)
    assert rows(reconcile.collisions(sec)) == [("KQ.A", 2)]
    with pytest.raises(reconcile.Collision, match="KQ.A"):
        reconcile.distinct_sec_tickers(sec)
    assert reconcile.distinct_sec_tickers(sec.limit(1)).count() == 1
    answers = [
        ("a", '{"data":[' + MATCH % "a" + "]}", None), ("b", '{"warning":"nothing"}', None), ("c", '{"data":[' + MATCH % "z" + "]}", None), ("d", '{"error":"bad"}', None),
        ("e", '{"data":[' + MATCH % "e" + "," + MATCH % "e" + "]}", None), ("f", None, "VendorError: status 500"), ("g", "no json", None),
    ]
    frame = spark.createDataFrame(answers, "security_id string, answer string, error string")
    found = reconcile.figi_lookup(frame).orderBy("security_id").collect()
    assert [(r["security_id"], r["exchange_ticker"], r["figi_error"]) for r in found] == [
        ("a", "KQ.A", None), ("b", None, "nothing"), ("c", None, "not a composite FIGI (composite is z)"), ("d", None, "bad"),
        ("e", None, "2 matches"), ("f", None, "VendorError: status 500"), ("g", None, "0 matches"),
    ]
    assert found[0]["security_type"] == "Common"
    assert rows(reconcile.resolvable(reconcile.figi_lookup(frame))) == [("a", "KQ.A")]
    picked = {r["ticker"]: (r["composite_figi"], r["problem"]) for r in reconcile.resolved_tickers(frame).collect()}
    assert picked["a"] == ("a", None) and picked["b"] == (None, "no match (nothing)") and picked["e"] == (None, "2 matches, not picking one")
    assert jobs.resolve(frame.where("security_id = 'a'")) == 0 and jobs.resolve(frame) == 1
    labels = spark.createDataFrame([("a", "KQ.A"), ("c", "OLD"), ("b", "B"), ("new", "N")], "security_id string, label string")
    stale = {r["security_id"]: (r["current_ticker"], r["problem"]) for r in reconcile.stale_labels(frame, labels).collect()}
    assert stale == {"b": (None, "no longer resolves"), "c": ("KQ.A", "renamed"), "new": (None, "no longer resolves")}
    assert jobs.check_labels(frame, labels) == 1 and jobs.check_labels(frame, labels.limit(1)) == 0


def test_vendor_lookups(spark):
    info = [("a", '{"symbol":"A","longName":"","shortName":"Short","exchange":"X","sector":"S"}', None), ("b", None, "slow"), ("c", "<html>", None)]
    got = {r["security_id"]: r for r in reconcile.yahoo_info(spark.createDataFrame(info, "security_id string, answer string, error string")).collect()}
    assert (got["a"]["yfinance_name"], got["a"]["yfinance_error"]) == ("Short", None)
    assert got["b"]["yfinance_error"] == "slow" and got["c"]["yfinance_error"] == "unreadable answer"
    asset = [("a", '{"id":"u-1","symbol":"A","exchange":"X","tradable":false}', None), ("b", None, "status 404")]
    got = {r["security_id"]: r for r in reconcile.alpaca_assets(spark.createDataFrame(asset, "security_id string, answer string, error string")).collect()}
    assert (got["a"]["alpaca_asset_id"], got["a"]["alpaca_tradable"], got["a"]["alpaca_error"], got["b"]["alpaca_error"]) == ("u-1", False, None, "status 404")


def test_calendar():
    """Days known from the exchanges' published calendars."""
    assert len(sessions.session_days(date(2022, 1, 1), date(2022, 12, 31))) == 251
    assert len(sessions.session_days(date(2024, 1, 1), date(2024, 12, 31))) == 252
    lasts = {date(2024, 7, 5): date(2024, 7, 3), date(2023, 4, 10): date(2023, 4, 6), date(2025, 1, 10): date(2025, 1, 8), date(2022, 6, 21): date(2022, 6, 17)}
    assert {d: sessions.last_completed_session(d) for d in lasts} == lasts
    assert sessions.default_range(date(2025, 3, 4)) == (date(2020, 3, 3), date(2025, 3, 3))
    assert sessions.default_range(date(2024, 3, 1), 1)[0] == date(2023, 2, 28)
    assert sessions.session_days(date(2026, 1, 3), date(2026, 1, 2)) == []
    assert date(2021, 12, 31) not in sessions.holidays(2021) | sessions.holidays(2022) and date(2023, 4, 7) in sessions.holidays(2023)


def test_completeness(spark, rows):
    securities = spark.createDataFrame([("B",), ("N",), ("N",), (None,)], "security_id string")
    days = spark.createDataFrame([(date(2025, 6, 6),)], "trade_date date")
    actual = spark.createDataFrame([("B", date(2025, 6, 6), "alpaca"), ("B", date(2025, 6, 6), "yahoo"), ("N", date(2025, 6, 6), "alpaca"), ("N", None, "yahoo")], "security_id string, trade_date date, source string")
    assert rows(quality.missing_bars(securities, days, ("alpaca", "yahoo"), actual)) == [("N", date(2025, 6, 6), "yahoo")]
    assert quality.missing_bars(securities.limit(0), days, ("alpaca",), actual).count() == 0
    assert quality.missing_bars(securities, days, ("alpaca",), actual.limit(0)).count() == 2


class Waits(list):
    def __call__(self, seconds):
        self.append(seconds)


def test_a_lane_waits_as_it_should():
    """Own spacing between requests, patience for a vendor's troubles, none for its refusals."""
    waits, answers = Waits(), iter([(200, "a"), (503, ""), (429, ""), (200, "b"), (404, "")])
    lane = vendors.Lane(lambda request: next(answers), vendors.Manner(per_minute=30, lanes=2, patience=(7, 9, 11), sleep=waits))
    assert [lane.ask({}), lane.ask({})] == ["a", "b"]
    assert waits == [4, 7, 4, 9, 4]
    with pytest.raises(vendors.VendorError, match="404"):
        lane.ask({})
    tries = []
    stubborn = vendors.Lane(lambda request: (tries.append(1) or 500, ""), vendors.Manner(patience=(1, 1), sleep=waits))
    with pytest.raises(vendors.VendorError, match="500"):
        stubborn.ask({})
    assert len(tries) == 3


QUICK = vendors.Manner(per_minute=1e9, patience=(0.0, 0.0))


def test_jobs_go_in_lists(spark, rows):
    def service(request):
        asked = json.loads(request["body"])
        if any(j["idValue"] == "g33" for j in asked):
            return 400, "bad list"
        return 200, json.dumps([{"data": [], "warning": j["idValue"] + f" of {len(asked)}"} for j in asked])

    ids = spark.range(35).repartition(1).select(F.concat(F.lit("g"), "id").alias("security_id"))
    got = {r["security_id"]: r for r in vendors.map_jobs(ids.select("security_id", vendors.figi_job(F.col("security_id")).alias("job")), service, manner=QUICK).collect()}
    assert len(got) == 35 and sum(r["error"] is not None for r in got.values()) in (5, 10)  # one list fails, alone
    assert all(json.loads(r["answer"])["warning"].startswith(i + " of ") for i, r in got.items() if r["answer"])
    assert max(int(r["answer"].rsplit(" ", 1)[1].rstrip('"}')) for r in got.values() if r["answer"]) == 10
    job = json.loads(spark.range(1).select(vendors.ticker_job(F.lit("KQ/A"))).first()[0])
    assert job == {"idType": "TICKER", "idValue": "KQ/A", "exchCode": "US", "marketSecDes": "Equity"}
    assert vendors.map_jobs(ids.limit(0).withColumn("job", F.lit("")), service, manner=QUICK).count() == 0


def test_requests_for_bars(spark):
    winter, summer = date(2025, 1, 31), date(2025, 7, 31)
    one = vendors.bar_params("alpaca", winter, summer)
    assert (one["start"], one["end"], one["feed"], one["adjustment"]) == ("2025-01-31T00:00:00-05:00", "2025-07-31T23:59:59-04:00", "sip", "raw")
    assert vendors.bar_params("alpaca", date(2025, 3, 9), date(2025, 3, 9))["end"] == "2025-03-09T23:59:59-04:00"  # the clocks change that day
    assert vendors.bar_params("yahoo", winter, summer)["end"] == "2025-08-01"  # the vendor leaves the end out
    row = vendors.bar_requests(spark.createDataFrame([("s", "K")], "security_id string, vendor_symbol string"), "yahoo", winter, summer).first()
    assert row["params"]["symbol"] == "K" and row["params"]["actions"] == "true" and (row["request_start"], row["request_end"]) == (winter, summer)


def test_fetching_over_http(spark):
    """Two pages by token, a security that is refused, one with a null list, over a server of this process."""
    seen = []

    class Vendor(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            query = {k: v[0] for k, v in urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query).items()}
            seen.append(query)
            symbol = query["symbols"]
            if symbol == "NO":
                return self.send_error(403)
            body = {"bars": None} if symbol == "NULL" else {"bars": {symbol: [1, 2], "ELSE": [1]}, "next_page_token": None if "page_token" in query else "more"}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Vendor)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        securities = spark.createDataFrame([("s1", "K"), ("s2", "NO"), ("s3", "NULL")], "security_id string, vendor_symbol string")
        requests = vendors.bar_requests(securities, "alpaca", date(2025, 6, 6), date(2025, 6, 6))
        fetched = vendors.fetch(requests, vendors.Http(f"http://127.0.0.1:{server.server_port}/bars"), QUICK).collect()
    finally:
        server.shutdown()
    got = sorted((r["security_id"], r["page"], r["record_count"], r["error"]) for r in fetched)
    assert got[:2] == [("s1", 0, 2, None), ("s1", 1, 2, None)] and got[2][3] == "VendorError: status 403" and got[3] == ("s3", 0, 0, None)
    assert all(q["feed"] == "sip" and q["adjustment"] == "raw" for q in seen)
    second = next(r for r in fetched if r["page"] == 1)
    assert json.loads(second["request_params"])["page_token"] == "more" and json.loads(second["payload"])["bars"]["K"] == [1, 2]


def test_gathering_asks_only_about_what_was_found(spark):
    def mapping(request):
        asked = json.loads(request["body"])
        return 200, json.dumps([{"data": [json.loads(MATCH % j["idValue"])]} if j["idValue"] == "s1" else {"warning": "unknown"} for j in asked])

    figis = spark.createDataFrame([("s1",), ("s2",)], "security_id string")
    content = spark.createDataFrame([('{"0":{"cik_str":4711,"ticker":"KQ-A","title":"K"}}',)], "content string")
    got = jobs.gather(spark, figis, content, {"mapping": mapping, "yfinance": lambda r: (200, json.dumps({"symbol": r["vendor_symbol"], "longName": "L"}))}, QUICK)
    assert [tuple(r)[:3] for r in got["yfinance"].collect()] == [("s1", "KQ-A", "L")]
    assert [tuple(r) for r in got["alpaca"].collect()] == [("s1", "no API key configured")]
    resolved, quarantined = reconcile.build_snapshot(got["figi"], got["sec"], got["yfinance"], got["alpaca"])
    assert [r["security_id"] for r in resolved.collect()] == ["s1"] and [r["quarantine_reason"] for r in quarantined.collect()] == ["OpenFIGI: unknown"]


def _record(folder, source, security, pages):
    at = folder / source / security
    at.mkdir(parents=True)
    for i, page in enumerate(pages):
        if page:
            (at / f"{i}.json").write_text(page)


def test_the_jobs_end_to_end(spark, tmp_path, capsys):
    lake = jobs.Lake(spark, str(tmp_path / "lake"))
    start = end = date(2025, 6, 6)
    recorded = vendors.RecordedFolder(str(tmp_path / "rec"))
    load = lambda first, last: jobs.load_bronze(lake, "alpaca", first, last, recorded, "night-9", QUICK)
    assert jobs.read_current(lake) is None and load(start, end) == 1  # no master yet
    inputs = dict(zip(("figi", "sec", "yfinance", "alpaca"), frames(spark), strict=True))
    assert jobs.build_security_master(lake, inputs, datetime(2025, 6, 1)) == 1  # two are quarantined, the rest is written
    said = capsys.readouterr().out
    assert "shared CIK22 s2 VOLT" in said and "quarantined s5 None OpenFIGI: 3 matches" in said and "yfinance_failures slow 1" in said
    assert jobs.inspect_security_master(lake) == 0
    bar = ("2025-06-06T04:00:00Z", 5, 6, 4, 5.5, 100, 10, 5.2)
    _record(tmp_path / "rec", "alpaca", "s1", [mapped("KQ.A", bar)])
    _record(tmp_path / "rec", "alpaca", "s2", [mapped("VOLT", bar, next_page_token="p2"), mapped("VOLT", bar)])
    _record(tmp_path / "rec", "alpaca", "s3", [mapped("VOLTB", bar, next_page_token="p2"), None])  # the second page is lost
    assert load(date(2025, 6, 7), date(2025, 6, 8)) == 0  # a weekend
    assert load(start, end) == 1
    assert "failed s3 VendorError: status 404" in capsys.readouterr().out
    held = lake.bronze("alpaca").read()
    assert sorted((r["security_id"], r["page"], r["record_count"]) for r in held.collect()) == [("s1", 0, 1), ("s2", 0, 1), ("s2", 1, 1)]
    assert json.loads(held.where("page = 1").first()["request_params"])["page_token"] == "p2"
    assert jobs.build_silver(lake, start, end) == 0 and jobs.build_silver(lake, start, end) == 0
    assert lake.bars.read().count() == 2 and lake.bars.versions() == [0, 1]
    assert jobs.check_completeness(lake, start, end) == 1
    assert jobs.check_completeness(lake, date(2025, 6, 7), date(2025, 6, 7)) == 0
    filings = spark.createDataFrame([("s1", date(2024, 5, 2), "acc-7", datetime(2024, 5, 3))], "security_id string, effective_date date, accession string, accepted_at timestamp")
    assert jobs.load_reorganizations(lake, filings) == 0 and jobs.load_reorganizations(lake, filings) == 0
    row = lake.actions.read().first()
    assert (row["action_type"], row["value"], row["source_run_id"], row["revision_count"], lake.actions.versions()) == ("reorg", None, "acc-7", 0, [0, 1])
    ran = []
    steps = [("a", lambda: ran.append("a") or 1), ("b", lambda: 1 / 0), ("c", lambda: ran.append("c") or 0)]
    assert jobs.backfill(steps) == 1 and ran == ["a", "c"] and jobs.backfill(steps[2:]) == 0


def test_streams(spark, tmp_path):
    frame = bronze(spark, ("alpaca", "KQ/A", ONE), ("alpaca", "KQ/A", ONE), ("yahoo", "x", TWO))
    frame.write.parquet(str(tmp_path / "in"))
    stream = deliveries.read_stream(spark, str(tmp_path / "in"))
    once = deliveries.run_to_end(deliveries.once(stream, F.col("payload")), "once")
    assert once.count() == 2


def test_windows_close_behind_the_watermark(spark, tmp_path, rows):
    """Batch by batch: a late row counts while its window is open, and is left out once the watermark has passed it."""
    base = bronze(spark, ("alpaca", "x", "p")).drop("ingested_at")
    for n, (day, hour) in enumerate([(1, 5), (3, 1), (1, 6), (20, 0), (21, 0), (2, 0)]):
        base.withColumn("ingested_at", F.lit(f"2025-06-{day:02d} {hour:02d}:00:00").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / f"{n}"))
        (tmp_path / "in").mkdir(exist_ok=True)
        file = next((tmp_path / f"{n}").glob("part-*.parquet"))
        at = tmp_path / "in" / f"{n}.parquet"
        file.rename(at)
        os.utime(at, (1_700_000_000 + n, 1_700_000_000 + n))  # the source takes the oldest first
    stream = deliveries.read_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    counts = deliveries.window_counts(stream, late="5 days", width="1 day")
    got = deliveries.run_to_end(counts, "counts", ["window_start", "source"])
    assert sorted(map(tuple, got.select(F.day("window_start"), "n_deliveries").collect())) == [(1, 2), (3, 1), (20, 1), (21, 1)]

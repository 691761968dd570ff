"""Consolidation of landed responses."""

from __future__ import annotations

import json
import random
from dataclasses import replace

import pytest
from conftest import category_job, paged_job, response, tag_job

from jobtide.plans import build
from jobtide.plans import responses as R
from jobtide.plans.staging import staging
from jobtide.sources.raw import Landing, read_failures, read_raw, read_runs

CATEGORY, TAG = R.FEEDS["remotive"], R.FEEDS["remoteok"]
PAGED = replace(R.FEEDS["adzuna"], per_page=2)


def payloads(frame, feed):
    rows = R.payloads(frame, feed).orderBy("run_id", "chunk").collect()
    return [json.loads(row["payload"]) for row in rows]


def ids(payload):
    return [job["id"] for job in payload["jobs"]]


def page(number, job_ids, run="1", **how):
    return response("adzuna", run, number, number - 1, {"results": [paged_job(i) for i in job_ids]}, country="gb", **how)


def test_category_filter_ignores_case_and_keeps_only_the_category_asked(responses):
    feed = [category_job(1, "DATA and analytics"), category_job(2, "Devops"), category_job(3, "Sales"), category_job(4, None)]
    [payload] = payloads(
        responses(
            response("remotive", "1", "data", 0, {"jobs": feed}), response("remotive", "1", "devops", 1, {"jobs": feed})
        ),
        CATEGORY,
    )
    assert ids(payload) == [1, 2]
    assert payload["job-count"] == 2
    assert payload["fetched-categories"] == ["data", "devops"]
    assert payload["failed-categories"] == {}


def test_tag_filter_drops_notices_and_postings_without_a_tag_list(responses):
    body = [{"legal": "x"}, tag_job("1", ["DEV"]), tag_job("2", ["other"]), {"id": "3"}, {"id": "4", "tags": "dev"}, {"id": None, "tags": ["dev", None]}]
    [payload] = payloads(responses(response("remoteok", "1", "dev", 0, body)), TAG)
    assert ids(payload) == ["1", None]


def test_first_seen_wins_and_missing_ids_all_stay(responses):
    first = [tag_job("1", title="a"), tag_job(None), tag_job("2")]
    second = [tag_job("2", title="late"), tag_job(None), tag_job(2), tag_job("3")]
    tagged = [{**job, "tags": ["dev", "backend"]} for job in first], [{**job, "tags": ["dev", "backend"]} for job in second]
    [payload] = payloads(
        responses(response("remoteok", "1", "dev", 0, tagged[0]), response("remoteok", "1", "backend", 1, tagged[1])), TAG
    )
    # The number 2 and the text "2" are different ids.
    assert ids(payload) == ["1", None, "2", None, 2, "3"]
    assert payload["jobs"][2].get("title") is None


def test_runs_do_not_share_ids(responses):
    both = payloads(responses(page(1, [1], "a"), page(1, [1], "b")), PAGED)
    assert [ids(p) for p in both] == [[1], [1]]


def test_short_page_stops_and_its_length_counts_repeats(responses):
    [payload] = payloads(responses(page(1, [1, 2]), page(2, [2, 2]), page(3, [3]), page(4, [4, 5])), PAGED)
    assert ids(payload) == [1, 2, 3]
    assert payload["fetched-pages"] == [1, 2, 3]
    assert payload["country"] == "gb"


def test_failed_page_does_not_stop(responses):
    [payload] = payloads(responses(page(1, [], status=500), page(2, [1, 2]), page(3, [3])), PAGED)
    assert ids(payload) == [1, 2, 3]
    assert payload["failed-pages"] == {"1": "Adzuna API returned HTTP 500 for https://adzuna.example/1"}


@pytest.mark.parametrize(
    ("how", "body", "message"),
    [
        ({"status": None, "error": "timeout"}, None, "Timeout after 30.0s while calling U"),
        ({"status": 429}, "{}", "Remotive API returned HTTP 429 for U"),
        ({"status": None, "error": "refused"}, None, "HTTP request to U failed: refused"),
        ({}, "<html>", "Remotive API returned a non-JSON response from U"),
        ({}, None, "Remotive API returned a non-JSON response from U"),
        ({}, '{"detail": 1}', "Unexpected shape in Remotive response: expected an object with a 'jobs' list"),
        ({}, '{"jobs": {}}', "Unexpected shape in Remotive response: expected an object with a 'jobs' list"),
        ({}, "[]", "Unexpected shape in Remotive response: expected an object with a 'jobs' list"),
        ({}, '{"jobs": []}', None),
    ],
)
def test_failure_messages(responses, how, body, message):
    row = R.outcomes(responses(response("remotive", "1", "qa", 0, body, **how)), CATEGORY).first()
    assert row["message"] == (message and message.replace("U", "https://remotive.example/qa") if message and "Unexpected" not in message else message)
    assert row["ok"] == (message is None)


def test_a_notice_that_is_no_object_fails_the_tag_feed(responses):
    row = R.outcomes(responses(response("remoteok", "1", "dev", 0, [1])), TAG).first()
    assert row["message"] == "Unexpected shape in RemoteOK response: expected an array of objects"


def test_runs_without_any_good_request_give_no_payload(responses):
    frame = responses(page(1, [], status=500), page(2, [], status=401), page(1, [9], "2"))
    assert [ids(p) for p in payloads(frame, PAGED)] == [[9]]
    summary = {row["run_id"]: row for row in R.run_summary(frame, ["adzuna"]).collect()}
    assert summary["1"]["status"] == "failed"
    assert summary["1"]["error"] == (
        "All pages failed during the Adzuna extraction: page 1: Adzuna API returned HTTP 500 for "
        "https://adzuna.example/1; page 2: Adzuna API returned HTTP 401 for https://adzuna.example/2"
    )
    assert summary["2"]["error"] is None


def test_large_runs_are_packed_into_several_payloads_without_losing_rows(responses):
    pages = [page(n, [2 * n, 2 * n + 1, 0, 1]) for n in range(1, 41)]
    packed = payloads(responses(*pages), PAGED)
    assert len(packed) == 3
    assert sorted(i for p in packed for i in ids(p)) == [0, 1, *range(2, 82)]
    assert [n for p in packed for n in p["fetched-pages"]] == list(range(1, 41))
    assert all(p["job-count"] == len(p["jobs"]) for p in packed)


def test_postings_keep_their_text(responses):
    title = 'quote " back\\slash \n tab\t é 漢字 🙂 </script>'
    [payload] = payloads(responses(response("remotive", "1", "data", 0, {"jobs": [category_job(1, title=title)]})), CATEGORY)
    assert payload["jobs"][0]["title"] == title


def test_unknown_source_is_refused(responses):
    with pytest.raises(ValueError, match="nosuch"):
        R.all_payloads(responses(page(1, [1])), ["nosuch"])


def test_every_failed_request_of_a_failed_run_is_listed(responses):
    frame = responses(*[page(n, [], status=500) for n in range(1, 41)])
    [row] = R.run_summary(frame, ["adzuna"]).collect()
    assert row["n_requests"] == 40 and row["error"].count("HTTP 500") == 40
    assert row["error"].index("page 2:") < row["error"].index("page 10:") < row["error"].index("page 40:")


def test_a_key_that_fails_again_keeps_its_last_message(responses):
    rows = [
        response("remotive", "1", "devops", 0, None, status=500),
        response("remotive", "1", "qa", 1, {"jobs": []}),
        response("remotive", "1", "devops", 2, None, status=429),
    ]
    [payload] = payloads(responses(*rows), CATEGORY)
    assert payload["failed-categories"] == {"devops": "Remotive API returned HTTP 429 for https://remotive.example/devops"}


def rows_of(runs):
    return {(r["source"], r["run_id"]): r for r in runs.collect()}


def test_landing_reports_every_run(three_sources, responses, tmp_path):
    more = responses(page(1, [], "2", status=500), page(1, [7], "3"), page(1, [], "4", status=401))
    runs = rows_of(build.land(three_sources.unionByName(more), str(tmp_path / "raw")))
    assert {k: r["status"] for k, r in runs.items() if k[0] == "adzuna"} == {
        ("adzuna", "1"): "succeeded", ("adzuna", "2"): "failed", ("adzuna", "3"): "succeeded", ("adzuna", "4"): "failed",
    }
    assert runs["remotive", "1"]["job_count"] == 2 and runs["remotive", "1"]["payloads"] == 1
    assert runs["adzuna", "4"]["error"].startswith("All pages failed during the Adzuna extraction: page 1: ")


def test_landing_raises_when_every_run_failed(responses, tmp_path):
    with pytest.raises(build.RunError, match="none of 1 run"):
        build.land(responses(page(1, [], status=500)), str(tmp_path / "raw"), ["adzuna"])


def test_every_failed_run_is_in_the_error_and_in_the_log(spark, responses, tmp_path):
    path = str(tmp_path / "raw")
    frame = responses(*[page(n, [], str(run), status=500) for run in range(9) for n in (1, 2)])
    with pytest.raises(build.RunError) as raised:
        build.land(frame, path, ["adzuna"])
    assert "none of 9 run(s)" in str(raised.value) and "adzuna 9" in str(raised.value) and f"{path}.runs" in str(raised.value)
    assert all(f"adzuna {run}: All pages failed" in str(raised.value) for run in range(9))
    assert read_runs(spark, path).where("status = 'failed' and error is not null").count() == 9
    rows = read_failures(spark, path).where("run_id = '4'").orderBy("chunk", "request_ordinal").collect()
    assert [r["request_key"] for r in rows] == ["1", "2"] and all("HTTP 500" in r["message"] for r in rows)
    assert not build.land(frame, path, ["adzuna"]).collect()


def test_nothing_is_gathered_of_a_run_that_went_well(responses):
    frame = responses(page(1, [1]), *[page(n, [], status=500) for n in range(2, 400)], page(1, [], "2", status=500))
    requests = R.outcomes(frame, PAGED)
    counts = R.run_counts(requests, PAGED)
    assert [r["run_id"] for r in R.failures(requests, counts, PAGED).collect()] == ["2"]


def everything(spark, path):
    raw = sorted((r["source"], r["run_id"], r["chunk"], r["payload"]) for r in read_raw(spark, path).collect())
    return raw, sorted(map(tuple, read_runs(spark, path).drop("ingested_at").collect()))


@pytest.mark.parametrize("lost", ["runs", "commit"])
def test_a_landing_that_broke_off_leaves_nothing(spark, three_sources, responses, tmp_path, monkeypatch, lost):
    """Wherever the driver is lost, the next landing gives what one landing gives."""
    path, whole = str(tmp_path / "raw"), str(tmp_path / "whole")
    first = responses(page(1, [], "0", status=500), page(1, [5], "9"))
    for to in (path, whole):
        build.land(first, to)
    build.land(three_sources, whole)
    write, after = Landing.write, {"payloads": "", "failures": ".failures", "runs": ".runs"}.get(lost)

    def breaking(self, rows, schema, suffix=""):
        out = write(self, rows, schema, suffix)
        if suffix == after:
            raise KeyboardInterrupt
        return out

    with monkeypatch.context() as patched:
        patched.setattr(Landing, "write", breaking)
        if lost == "commit":
            patched.setattr(Landing, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            build.land(three_sources, path)
    assert read_raw(spark, path).count() == 1 and read_runs(spark, path).count() == 2
    build.land(three_sources, path)
    assert everything(spark, path) == everything(spark, whole)
    ids = [r["raw_id"] for r in read_raw(spark, path).collect()]
    assert len(set(ids)) == len(ids)


@pytest.mark.parametrize("count", [2, 3, 5, 8, 12])
def test_the_newest_of_many_runs_landed_at_once_wins(spark, responses, tmp_path, count):
    path = str(tmp_path / "raw")
    frame = responses(
        *[response("remotive", str(n), "data", 0, {"jobs": [category_job(1, title=f"from run {n}")]}) for n in range(1, count + 1)]
    )
    build.land(frame.repartition(5), path)
    raw = read_raw(spark, path, "remotive")
    assert [r["run_id"] for r in raw.orderBy("raw_id").collect()] == [str(n) for n in range(1, count + 1)]
    assert [r["title"] for r in staging(raw, "remotive").collect()] == [f"from run {count}"]


def test_runs_are_landed_once_and_a_late_older_run_does_not_win(spark, responses, tmp_path):
    path = str(tmp_path / "raw")
    runs = {n: response("remotive", str(n), "data", 0, {"jobs": [category_job(1, title=f"from run {n}")]}) for n in (1, 2, 3)}
    build.land(responses(runs[1], runs[3]), path)
    assert set(rows_of(build.land(responses(*runs.values()), path))) == {("remotive", "2")}
    assert not build.land(responses(*runs.values()), path).collect()
    assert read_raw(spark, path).count() == read_raw(spark, path).select("raw_id").distinct().count() == 3
    assert [r["title"] for r in staging(read_raw(spark, path, "remotive"), "remotive").collect()] == ["from run 3"]


def test_chunks_of_a_large_run_keep_their_identity(spark, responses, tmp_path):
    path = str(tmp_path / "raw")
    build.land(responses(*[page(n, range(n * 100, n * 100 + 50)) for n in range(1, 41)]), path)
    rows = read_raw(spark, path).orderBy("raw_id").collect()
    assert [(r["run_id"], r["chunk"]) for r in rows] == [("1", 0), ("1", 1), ("1", 2)]


def merged(rows, feed):
    """Plain-Python merge of one run's responses: kept jobs, good requests, failed requests."""
    jobs, seen, good, bad = [], set(), [], []
    for _, _, key, _, _, status, error, body, _, _ in rows:
        try:
            content = json.loads(body) if status == 200 and error is None else None
        except ValueError:
            content = None
        listed = content if feed.list_name is None else (content or {}).get(feed.list_name)
        if not isinstance(listed, list) or not all(isinstance(job, dict) for job in listed):
            bad.append(key)
            continue
        good.append(key)
        for job in listed:
            if feed.list_name is None and "id" not in job:
                continue
            if feed.categories and str(job.get("category")).lower() != feed.categories[key].lower():
                continue
            tags = job.get("tags")
            if feed.by_tag and (not isinstance(tags, list) or key not in [str(tag).lower() for tag in tags]):
                continue
            ident = (type(job["id"]), job["id"]) if job.get("id") is not None else None
            if ident is None or ident not in seen:
                seen.add(ident)
                jobs.append(job)
        if feed.per_page and len(listed) < feed.per_page:
            break
    return jobs, good, bad


@pytest.mark.parametrize("source", ["remotive", "remoteok", "adzuna"])
def test_random_runs_match_a_plain_merge(responses, source):
    rng = random.Random(source)
    feed = {"remotive": CATEGORY, "remoteok": TAG, "adzuna": PAGED}[source]
    runs = {}
    for run in range(25):
        size = rng.choice([1, 3, 5, 40])
        keys = [str(i + 1) for i in range(size)] if feed.per_page else rng.sample(list(feed.categories or R.fixed.REQUEST_TAGS), min(size, 5))
        rows = []
        for ordinal, key in enumerate(keys):
            jobs = []
            for _ in range(rng.choice([1, 2, 2, 3, 4])):
                job = {"id": rng.choice([None, 1, 2, 3, "1", "2", rng.randrange(500)]), "n": rng.random()}
                job["category"] = rng.choice(["Devops", "DEVOPS", "Data and Analytics", "Sales", None, 7])
                job["tags"] = rng.choice([["dev"], ["Backend", "DEV"], ["x"], [], "dev", None, [None, 3, "devops"]])
                if rng.random() < 0.1:
                    del job["id"]
                jobs.append(job)
            if rng.random() < 0.05:
                jobs.append(rng.choice([5, "text", None, [1]]))
            body = jobs if feed.list_name is None else {feed.list_name: jobs}
            broken = rng.random()
            if broken < 0.1:
                rows.append(response(source, str(run), key, ordinal, body, status=500))
            elif broken < 0.15:
                rows.append(response(source, str(run), key, ordinal, "<html>"))
            elif broken < 0.2:
                rows.append(response(source, str(run), key, ordinal, {"detail": 1}))
            else:
                rows.append(response(source, str(run), key, ordinal, body, country="gb"))
        runs[str(run)] = rows
    frame = responses(*[row for rows in runs.values() for row in rows]).repartition(7)
    got: dict = {}
    for row in R.payloads(frame, feed).orderBy("run_id", "chunk").collect():
        payload = json.loads(row["payload"])
        assert payload["job-count"] == len(payload["jobs"]) == row["job_count"]
        jobs, good, bad = got.setdefault(row["run_id"], ([], [], []))
        jobs += payload["jobs"]
        good += [str(key) for key in payload[f"fetched-{feed.requests}"]]
        bad += payload[f"failed-{feed.requests}"]
    want = {run: merged(rows, feed) for run, rows in runs.items()}
    assert got == {run: parts for run, parts in want.items() if parts[1]}
    summary = {r["run_id"]: r["status"] for r in R.run_summary(frame, [source]).collect()}
    assert summary == {run: "succeeded" if parts[1] else "failed" for run, parts in want.items()}

import gzip
import json
import threading
import time
from http.server import BaseHTTPRequestHandler, HTTPServer

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from siftwork.operators import ngrams
from siftwork.plans import curation
from siftwork.schema import THREAD
from siftwork.sources import readers, remote, writers
from siftwork.streaming import ingest


def test_benchmark_lines(spark, tmp_path):
    lines = ['{"task_id":1,"task":"\\\\{a\\\\}","solution":"s","answer":"","type":null}'.replace("\\\\", "\\"), "", "{broken", '{"task_id":2,"task":"\\\\dots \\{","solution":"x"}']
    (tmp_path / "b.jsonl").write_text("\n".join(lines))
    rows = {r.task_id: r for r in readers.read_benchmark(spark, str(tmp_path)).collect()}
    assert rows[1].task == "\\{a\\}" and rows[2].task == "\\dots \\{" and rows[2].benchmark_name == "b" and len(rows) == 2
    with pytest.raises(FileNotFoundError):
        readers.read_benchmark(spark, str(tmp_path / "none"))


def test_sources(spark, tmp_path):
    folder = tmp_path / "sets" / "one"
    folder.mkdir(parents=True)
    (folder / readers.MARKER).write_text("{}")
    table = pa.table({"q": ["a", "b"], "n": [1, 2]})
    with pa.OSFile(str(folder / "data-0.arrow"), "wb") as f, pa.ipc.new_stream(f, table.schema) as w:
        w.write_table(table)
    with gzip.open(tmp_path / "x.jsonl.gz", "wt") as f:
        f.write(json.dumps({"q": "c", "extra": True}) + "\n")
    got = readers.read_sources(spark, [str(tmp_path / "sets"), str(tmp_path / "x.jsonl.gz")])
    assert sorted((r.q, r.n, r.extra) for r in got.collect()) == [("a", 1, None), ("b", 2, None), ("c", None, True)]
    assert readers.read_sources(spark, [str(folder), str(tmp_path / "x.jsonl.gz")], limit=1, order_cols=["q"]).count() == 2
    with pytest.raises(FileNotFoundError):
        readers.read_source(spark, str(tmp_path))


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, None, True), (2, "x", False)], "id int, t string, gone boolean")
    writers.write_sides(df, "gone", str(tmp_path / "sides"))
    assert [r.id for r in spark.read.parquet(str(tmp_path / "sides")).where("status='removed'").collect()] == [1]
    writers.append_json(df, str(tmp_path / "j"))
    writers.append_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 4
    assert any('"t":null' in r.value for r in spark.read.text(str(tmp_path / "j")).collect())
    assert not writers.write_splits(df.where("false").withColumn("split", F.lit("train")), str(tmp_path / "s"))
    nested = df.select(F.struct("id", F.lit("p").alias("_source_path")).alias("metadata"))
    assert writers.flatten(nested).columns == ["id"]


def test_predictions(spark, tmp_path):
    rows = spark.createDataFrame([(1, "$1/2$", "0.5"), (2, "3", None), (3, "7", "\\boxed{7}")], "id int, gold string, got string")
    table = writers.write_predictions(rows, "gold", "got", str(tmp_path / "p")).first()
    assert table.n == 3 and abs(table.accuracy - 2 / 3) < 1e-9
    assert {r.id: r.same for r in spark.read.json(str(tmp_path / "p")).collect()} == {1: True, 2: False, 3: True}


def test_done_urls(spark, tmp_path):
    (tmp_path / "o.jsonl").write_text('{"url":"a"}\n\nnonsense\n{"x":1}\n{"url":"a"}\n')
    assert [r.url for r in readers.done_urls(spark, str(tmp_path / "o.jsonl")).collect()] == ["a"]


def test_fetcher_backs_off():
    def fetcher(*answers, **how):
        seen, waits = iter(answers), []

        def get(_):
            got = next(seen)
            if isinstance(got, Exception):
                raise got
            return got

        return remote.PageFetcher(get, waits.append, **how), waits

    f, waits = fetcher((429, ""), (429, ""), (200, "ok"))
    assert f("u") == "ok" and waits == [5.0, 10.0]
    f, waits = fetcher((503, ""), TimeoutError(), (502, ""), (200, "ok"))
    assert f("u") == "ok" and waits == [3.0, 6.0, 9.0]
    f, waits = fetcher((404, ""))
    assert f("u") is None and waits == []
    f, waits = fetcher(*[OSError()] * 3, attempts=3)
    assert f("u") is None and waits == [3.0, 6.0]
    f, waits = fetcher((200, "ok"), pause=(1.0, 2.0))
    assert f("u") == "ok" and 1.0 <= waits[0] <= 2.0


def test_chat_model_speaks_to_an_endpoint():
    asked = []

    class Endpoint(BaseHTTPRequestHandler):
        def do_POST(self):
            asked.append((self.path, self.headers["Authorization"], json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            body = json.dumps({"choices": [{"message": {"content": "" if len(asked) > 1 else " YES "}}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Endpoint)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        model = remote.ChatModel(f"http://127.0.0.1:{server.server_port}/v1/", "m", "k")
        assert model("s", "u") == " YES "
        with pytest.raises(ValueError):
            model("s", "u")
    finally:
        server.shutdown()
    assert asked[0][0] == "/v1/chat/completions" and asked[0][1] == "Bearer k" and [m["content"] for m in asked[0][2]["messages"]] == ["s", "u"]


def test_remote_shards(spark, tmp_path):
    shards = []
    for k in range(3):
        shards.append(str(tmp_path / f"{k}.parquet"))
        pq.write_table(pa.table({"q": [f"a{k}", f"b{k}"], "n": [k, None]}), shards[-1])

    def fetch(path):
        with open(path, "rb") as f:
            return f.read()

    rows = remote.read_remote(spark, "org/set", shards, fetch).collect()
    assert sorted(r.q for r in rows) == ["a0", "a1", "a2", "b0", "b1", "b2"] and {r._source_repo for r in rows} == {"org/set"}
    assert remote.read_remote(spark, "org/set", shards, fetch, limit=1).count() == 3


def test_sources_by_uri_and_benchmark_keys(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"q":"c"}\n')
    folder = tmp_path / "saved"
    folder.mkdir()
    (folder / readers.MARKER).write_text("{}")
    table = pa.table({"problem": ["a b", "c d"], "answer_text": ["e", "f"], "key": [7, None]})
    with pa.OSFile(str(folder / "data-0.arrow"), "wb") as f, pa.ipc.new_file(f, table.schema) as w:
        w.write_table(table)
    uri = "file://" + str(tmp_path)
    assert readers.read_source(spark, f"{uri}/x.jsonl").first().q == "c"
    assert readers.read_source(spark, uri + "/saved").count() == 2 and readers.is_dataset_dir(spark, uri + "/saved")
    rows = readers.read_benchmark(spark, uri + "/saved", "problem", "answer_text", "key").orderBy("ordinal").collect()
    assert [(r.task_id, r.task, r.solution, r.benchmark_name, r.ordinal) for r in rows] == [(7, "a b", "e", "saved", 0), (None, "c d", "f", "saved", 1)]
    named = ngrams.build_index(readers.read_benchmark(spark, uri + "/saved", "problem", "answer_text", "key"), 2)
    assert {r.task_name for r in named.collect()} == {"saved_task7", "saved_1"}
    writers.write_index(named, str(tmp_path / "index"))
    assert writers.read_index(spark, str(tmp_path / "index")).exceptAll(named).count() == 0


def thread(url, *contents):
    return ("src", url, "t", None, [(i, "a", None, c, False) for i, c in enumerate(contents)])


QUESTION = "Wykaż, że dla każdej liczby naturalnej n liczba n(n+1) jest parzysta i podaj uzasadnienie."


def test_curation_gates(spark):
    df = spark.createDataFrame([thread("u1", QUESTION, "Jedna z liczb \\(n, n+1\\) jest parzysta."), thread("u2", "hm"), thread("u3", QUESTION), thread("u4")], THREAD)
    full = curation.curate(df, "url")
    rows = {r.url: r for r in full.collect()}
    assert {k: r.status for k, r in rows.items()} == {"u1": "kept", "u2": "discarded", "u3": "no_answer", "u4": "discarded"}
    assert rows["u1"].category == "PROOF" and rows["u1"].solution == "Jedna z liczb $n, n+1$ jest parzysta." and rows["u1"].answer_post_index == 1
    assert curation.clean_records(full).columns == ["source_url", "question", "category", "solution"]
    stats = curation.statistics(full, "url").first()
    assert (stats.threads, stats.kept, stats.filtered_out, stats.errors) == (4, 1, 3, 0)


def test_a_failed_call_passes_no_gate(spark):
    df = spark.createDataFrame([thread("u1", QUESTION, "Jedna z liczb jest parzysta."), thread("u2", "hm")], THREAD)
    config = curation.Config(retries=2, pause=0.0, timeout=0.5)
    # the words by which a stage is told from its prompt
    for stage in ("JSON list", "DECISION", "CATEGORY", "POST_INDEX", "draft", "LaTeX"):
        for fault in ("raises", "empty", "hangs"):
            if fault == "hangs" and stage != "DECISION":
                continue

            def model(system, user, stage=stage, fault=fault):
                if stage not in system:
                    return curation.rule_model(system, user)
                if fault == "hangs":
                    time.sleep(3)
                if fault == "raises":
                    raise RuntimeError("down")
                return " "

            full = curation.curate(df, "url", model, config)
            got = {r.url: r.status for r in full.collect()}
            later = stage in ("CATEGORY", "POST_INDEX", "draft")
            assert got == {"u1": "error", "u2": "discarded" if later else "error"}, (stage, fault)
            stats = curation.statistics(full, "url").first()
            assert (stats.kept, stats.errors) == (0, 1 if later else 2)
            assert curation.clean_records(full).count() == 0


def test_a_split_that_is_no_list_is_counted(spark):
    df = spark.createDataFrame([thread("u1", QUESTION, "Jedna z liczb jest parzysta.")], THREAD)
    full = curation.curate(df, "url", lambda s, u: "I see one problem." if "JSON list" in s else curation.rule_model(s, u))
    stats = curation.statistics(full, "url").first()
    assert (stats.tasks, stats.kept, stats.parse_errors, stats.errors) == (1, 1, 1, 0)


def test_settings_from_the_environment():
    config = curation.Config.from_env({"SIFTWORK_RETRIES": "7", "SIFTWORK_TIMEOUT": "2.5", "SIFTWORK_PROMPT_KEEP": "Keep? DECISION:"})
    assert (config.retries, config.timeout, config.in_flight, config.prompts.keep) == (7, 2.5, 8, "Keep? DECISION:")
    assert config.prompts.split == curation.Prompts().split


def test_streaming_goes_on_behind_the_last_batch(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", tmp_path / "out", str(tmp_path / "c")
    folder.mkdir()

    def put(name, *urls):
        (folder / name).write_text("".join(json.dumps({"url": u, "title": "t", "posts": []}) + "\n" for u in urls))
        ingest.run_batches(ingest.new_threads(spark, str(folder), THREAD), ingest.append_once(str(out)), checkpoint).awaitTermination()
        return sorted(r.url for r in spark.read.json(str(out)).collect())

    assert put("1.json", "a", "b") == ["a", "b"]
    assert put("2.json", "b", "c") == ["a", "b", "c"]


def test_command_line(spark, tmp_path):
    from siftwork import cli

    other = "inne pytanie o coś zupełnie innego niż tamto i jeszcze dłuższe od niego"
    # a copy and a repeated key: every row comes out on one side
    rows = [{"k": 1, "question": QUESTION, "raw_answer": "tak"}, {"k": 1, "question": QUESTION, "raw_answer": "tak"}, {"k": 1, "question": other, "raw_answer": None}]
    (tmp_path / "in.jsonl").write_text("".join(json.dumps(r) + "\n" for r in rows))
    (tmp_path / "b.jsonl").write_text(json.dumps({"task_id": 1, "task": other, "solution": "s"}) + "\n")
    (tmp_path / "c.jsonl").write_text(json.dumps({"task_id": 2, "task": "nic wspólnego", "solution": "s"}) + "\n")
    source = "file://" + str(tmp_path / "in.jsonl")

    def sides(folder):
        got = spark.read.parquet(str(tmp_path / folder)).collect()
        return sorted((r.status, r.question) for r in got)

    for key in ([], ["--id-key", "k"]):
        cli.main(["--verbose", "dedup", source, "--output", str(tmp_path / "d"), *key], spark)
        assert sides("d") == [("clean", QUESTION), ("clean", other), ("removed", QUESTION)]
    cli.main(["decontaminate", source, "--benchmark", str(tmp_path / "c.jsonl"), str(tmp_path / "b.jsonl"), "--index-dir", str(tmp_path / "i"), "--output", str(tmp_path / "c")], spark)
    assert sides("c") == [("clean", QUESTION), ("clean", QUESTION), ("removed", other)]
    assert spark.read.parquet(str(tmp_path / "c")).where("status = 'removed'").first().contaminated_task == "b_task1"
    cli.main(["decontaminate", source, "--index-dir", str(tmp_path / "i"), "--output", str(tmp_path / "e")], spark)
    assert sides("e") == sides("c")
    cli.main(["preview", source], spark)
    cli.main(["split", source, "--key", "question", "--fraction", "0.5", "--output", str(tmp_path / "s")], spark)
    assert spark.read.parquet(str(tmp_path / "s")).count() >= 3


def test_command_line_curates_and_crawls(spark, tmp_path):
    from siftwork import cli

    (tmp_path / "t.jsonl").write_text(json.dumps({"url": "u1", "title": "t", "posts": [{"index": 0, "author": "a", "content": QUESTION}, {"index": 1, "author": "b", "content": "Jedna z liczb jest parzysta."}]}) + "\n")
    with pytest.raises(SystemExit):
        cli.main(["curate", str(tmp_path / "t.jsonl"), "--output", str(tmp_path / "o")], spark)
    cli.main(["curate", str(tmp_path / "t.jsonl"), "--dry-run", "--output", str(tmp_path / "o")], spark)
    assert [r.category for r in spark.read.json(str(tmp_path / "o" / "clean")).collect()] == ["PROOF"]
    (tmp_path / "urls.txt").write_text("p1\n\np2\np3\n")
    (tmp_path / "done.jsonl").write_text('{"url":"p1"}\n')
    cli.main(["crawl", str(tmp_path / "urls.txt"), "--done", str(tmp_path / "done.jsonl"), "--output", str(tmp_path / "pages")], spark, get=lambda u: (200, f"<p>{u}</p>") if u == "p2" else (404, None))
    assert [(r.url, bytes(r.body)) for r in spark.read.parquet(str(tmp_path / "pages")).collect()] == [("p2", b"<p>p2</p>")]


def test_old_addresses_leave_the_stream_state(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"url":"a"}\n{"url":"a"}\n')
    assert "Watermark" in ingest.new_threads(spark, str(tmp_path), THREAD)._jdf.queryExecution().analyzed().toString()
    assert "Watermark" not in ingest.new_threads(spark, str(tmp_path), THREAD, kept=None)._jdf.queryExecution().analyzed().toString()

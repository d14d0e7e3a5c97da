"""Sources, sinks, the command line and the stream, on files of a temporary folder."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import dedup, filters, standardize, tokens
from corpusloom.plans import cli
from corpusloom.scratch import Scratch, shared_dir
from corpusloom.sources import io
from corpusloom.streaming.filter_stream import filter_stream

ROWS = [(i, f"document {i} has words\nand a second line number {i} " + "filling text " * 30) for i in range(12)] + [(90, ""), (91, None), (92, "document 3 has words")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The same rows as Parquet, JSON lines, gzip JSON lines, and in nested folders."""
    root = tmp_path_factory.mktemp("in")
    frame = spark.createDataFrame(ROWS, "doc_id long, text string")
    frame.coalesce(1).write.parquet(f"{root}/parquet")
    lines = [json.dumps({"doc_id": i, "text": t}) for i, t in ROWS]
    (root / "json").mkdir()
    (root / "json" / "a.jsonl").write_text("\n".join(lines[:7]))
    with gzip.open(root / "json" / "b.jsonl.gz", "wt") as f:
        f.write("\n".join(lines[7:]))
    (root / "deep" / "x" / "y").mkdir(parents=True)
    (root / "deep" / "x" / "y" / "c.jsonl").write_text("\n".join(lines))
    return root


def rows(df):
    return sorted((r["doc_id"], r["text"] or "") for r in df.collect())


WANTED = sorted((i, t or "") for i, t in ROWS)


def test_scans(spark, folder):
    schema = "doc_id long, text string"
    assert rows(io.scan(spark, f"{folder}/parquet")) == WANTED
    assert rows(io.scan(spark, f"{folder}/json", "json")) == WANTED
    assert rows(io.scan(spark, f"{folder}/js*/*", "json", schema)) == WANTED
    assert io.scan(spark, f"{folder}/json/*.gz", "json", schema).count() == len(ROWS) - 7
    assert rows(io.scan(spark, f"{folder}/deep", "json", schema, recursive=True)) == WANTED
    with pytest.raises(ValueError, match="csv"):
        io.scan(spark, str(folder), "csv")


def test_corrupt_files_are_passed_over_if_asked(spark, folder, tmp_path):
    spark.createDataFrame(ROWS, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/t")
    (tmp_path / "t" / "part-bad.parquet").write_bytes(b"PAR1 not a file PAR1")
    assert rows(io.scan(spark, f"{tmp_path}/t", schema="doc_id long, text string", ignore_corrupt=True)) == WANTED
    with pytest.raises(Exception, match="(?i)parquet|footer|corrupt|read"):
        io.scan(spark, f"{tmp_path}/t", schema="doc_id long, text string").collect()


def test_bytes_columns_and_reports(spark, folder, tmp_path):
    assert io.input_bytes(spark, f"{folder}/json/*") == sum(p.stat().st_size for p in (folder / "json").iterdir())
    assert io.input_bytes(spark, f"{folder}/none*") == 0
    frame = io.scan(spark, f"{folder}/parquet")
    assert io.require_column(frame, "text") is frame
    with pytest.raises(ValueError, match="absent"):
        io.require_column(frame, "absent")
    io.write_report(spark, {"a": "ü"}, f"{tmp_path}/r/report.json")
    assert json.loads((tmp_path / "r" / "report.json").read_text()) == {"a": "ü"}
    io.write_report(spark, {"a": "ü"}, f"file://{tmp_path}/store")
    assert json.loads(spark.read.text(f"{tmp_path}/store").first()[0]) == {"a": "ü"}


def test_library_tokens(spark, folder):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    found = tokens.totals(tokens.target(io.scan(spark, f"{folder}/parquet")), tokens.library_tokens(path)).first()
    assert (found["total_docs"], found["total_tokens"]) == (len(ROWS), sum(len(own.encode(t, add_special_tokens=False).ids) for _, t in ROWS if t))
    with pytest.raises(Exception, match="(?i)no such file|error"):
        tokens.totals(tokens.target(io.scan(spark, f"{folder}/parquet")), tokens.library_tokens("/none.json")).first()


def test_model_that_fails_drops_the_row(spark):
    def load():
        def score(texts):
            if any("bad" in t for t in texts):
                raise ValueError
            return [1.0 for _ in texts]

        return score

    frame = spark.createDataFrame([("good " * 60,), ("bad " * 60,)], "text string").coalesce(1)
    assert [r["text"][:4] for r in filters.clean(frame, filters.model_score(load)).collect()] == ["good"]


def test_four_outputs_are_written_and_read_again(spark, tmp_path):
    words = " ".join(f"w{i}" for i in range(60))
    frame = spark.createDataFrame([(1, words), (2, words), (3, words + " x"), (4, "other words entirely here now"), (None, "only a null id"), (1, "again one")], "doc_id long, text string")
    dedup.near_dedup(frame, dedup.DedupConfig(num_perm=32, b=16, r=2), Scratch(spark, "t")).write(str(tmp_path))
    read = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("dedup", "wcc", "dup", "result")}
    assert {n: df.count() for n, df in read.items()} == {"dedup": 5, "wcc": 2, "dup": 1, "result": 4}
    assert [r["doc_id"] for r in read["dup"].collect()] == [3]


def test_exact_dedup_with_null_and_repeated_keys(spark):
    given = [(None, "only null id", "x"), (1, "a", "x"), (1, "b", "y"), (2, "b", "z"), (0, "b", "z"), (1, "a", "x"), (5, None, "n"), (6, None, "n"), (None, "a", "q")]
    frame = spark.createDataFrame(given, "doc_id long, text string, keep string").withColumn("row", F.lit(1)).withColumn("digest", F.lit(2))
    got = dedup.exact_dedup(frame)
    assert got.columns == frame.columns
    assert sorted(((r["doc_id"], r["text"], r["keep"]) for r in got.collect()), key=str) == sorted([(None, "only null id", "x"), (1, "a", "x"), (0, "b", "z"), (5, None, "n")], key=str)
    assert dedup.exact_dedup(frame.limit(0)).count() == 0


def test_signature_of_null_text_is_that_of_no_shingle(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "a b c d e f")], "doc_id long, text string")
    got = {r["uid"]: set(r["signature"]) for r in dedup.signatures(frame, dedup.DedupConfig(num_perm=8)).collect()}
    assert got[1] == got[2] == {2**32 - 1} != got[3]
    assert [r["uid"] for r in dedup.signatures(frame, dedup.DedupConfig(num_perm=8, isolate_short=True)).collect()] == [3]


def test_quarantine_commands_and_snapshots(spark):
    raw = spark.createDataFrame([("hello", 1, "u", "w"), ("", 2, "u", "w")], "text string, previous_word_count long, url string, warcinfo string")
    assert [r["invalid"] for r in standardize.adapt(raw, "dclm", F.col("previous_word_count"), "quarantine").collect()] == [False, True]
    assert standardize.batch_commands(["stack_edu-C"], "run {task} {adapter}") == ["run stack_edu-C dolma3_mix_code"]
    assert (standardize.crawl_snapshot(["a", "b"], 1), standardize.crawl_snapshot(["a"], 0, "z")) == ("b", "z")
    with pytest.raises(ValueError, match="snapshot"):
        standardize.crawl_snapshot(["a"], 4)


def test_command_line(spark, folder, tmp_path, capsys):
    run = lambda *args: cli.main([*args, "--input", f"{folder}/parquet"])
    run("filter", "--output", f"{tmp_path}/kept", "--min-lines", "2")
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 12
    run("dedup", "--output", f"{tmp_path}/near", "--num-perm", "32", "--b", "16", "--r", "2")
    assert spark.read.parquet(f"{tmp_path}/near/result").count() + spark.read.parquet(f"{tmp_path}/near/dup").count() == len(ROWS)
    run("tokens", "--output", f"{tmp_path}/report.json", "--sample-n", "2")
    report = json.loads((tmp_path / "report.json").read_text())
    assert report["total_docs"] == len(ROWS) and len(report["details"]["samples"]) == 2
    spark.createDataFrame([("hello there", 1, "u", "w")], "text string, previous_word_count long, url string, warcinfo string").write.parquet(f"{tmp_path}/raw")
    cli.main(["standardize", "--adapter", "dclm", "--input", f"{tmp_path}/raw", "--output", f"{tmp_path}/standard", "--num-partitions", "1"])
    assert spark.read.parquet(f"{tmp_path}/standard").first()["meta"]["source"] == "dclm-baseline-1.0"
    assert "tokens:" in capsys.readouterr().out


def test_stream_gives_the_batch_rows(spark, folder, tmp_path):
    filter_stream(spark, f"{folder}/parquet", "doc_id long, text string", f"{tmp_path}/out", f"{tmp_path}/state", min_lines=2).awaitTermination(120)
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(filters.clean(io.scan(spark, f"{folder}/parquet"), min_lines=2))


def test_scratch_is_in_the_session_folder(spark):
    assert Scratch(spark, "t").root.startswith(shared_dir(spark)) and shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")

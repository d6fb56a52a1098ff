import csv
import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gristmill.operators import retrieval, sampling
from gristmill.sources import quoted, readers, writers
from gristmill.streaming import indexing


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", x', None), (2, "two\nlines", 0.5)],
                               "a int, b string, c double")
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        writers.write_table(df, path, fmt, single_file=True)
        back = readers.read_table(spark, path, fmt, df.schema)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert readers.read_table(spark, str(tmp_path / "csv")).schema["a"].dataType.typeName() \
        == "integer"
    with pytest.raises(ValueError):
        readers.read_table(spark, "x", "orc")
    with pytest.raises(ValueError):
        writers.write_table(df, "x", "orc")


def test_csv_in_parts(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(spark.range(50), path, "csv")
    assert readers.read_table(spark, path, "csv", "id long", one_line_rows=True).count() == 50


CELLS = ["plain", 'say "hi"', "two\nlines", "a\r\nb", "", None, "x,y", '"', '""', "\n\n", "é\n\"z\"",
         "line\n" * 40]


@pytest.mark.parametrize("size", ["64", "100", "777"])
def test_quoted_line_ends_and_splits_go_together(spark, tmp_path, size):
    """Splits far smaller than some records: same rows as read by one task."""
    rng = random.Random(int(size))
    rows = [(i, *(rng.choice(CELLS) for _ in range(2)), rng.random()) for i in range(300)]
    for number in range(2):
        with open(tmp_path / f"part{number}.csv", "w", newline="") as file:
            out = csv.writer(file, lineterminator="\r\n" if number else "\n")
            out.writerow(["id", "a", "two\nline name", "x"])
            out.writerows(rows[number::2])
    schema = "id int, a string, b string, x double"
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    once = spark.read.schema(schema).option("header", True).option("multiLine", True).option(
        "escape", '"').option("mode", "FAILFAST").csv(str(tmp_path))
    want = sorted(map(tuple, once.collect()), key=lambda r: r[0])
    assert [r[0] for r in want] == list(range(300))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        table = readers.read_table(spark, str(tmp_path), "csv", schema)
        got = sorted(map(tuple, table.collect()), key=lambda r: r[0])
        assert [(a, _lf(b), _lf(c), d) for a, b, c, d in got] == [
            (a, _lf(b), _lf(c), d) for a, b, c, d in want]
        inferred = readers.read_table(spark, str(tmp_path))
        assert inferred.columns == ["id", "a", "two\nline name", "x"]
        assert [t for _, t in inferred.dtypes] == ["int", "string", "string", "double"]
        assert inferred.count() == 300
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _lf(text):
    """Line ends inside cells are line feeds, whatever the file has."""
    return text and text.replace("\r\n", "\n")


def test_large_csv_is_read_by_many_tasks(spark, tmp_path):
    body = "".join(f'{i},"cell {i}\nwith ""two"" lines"\n' for i in range(40_000))
    (tmp_path / "t.csv").write_text("id,text\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        table = readers.read_table(spark, str(tmp_path / "t.csv"), "csv", "id long, text string")
        rows = table.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count("*").alias("n"), F.sum("id").alias("ids")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) > 10 and sum(r.n for r in rows) == 40_000
    assert sum(r.ids for r in rows) == sum(range(40_000))


def test_kinds_of_inferred_columns(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "i,l,d,day,at,flag,text,none,mixed\n1,5000000000,1.5,2024-01-31,2024-01-31 10:00:00,true,x,,1\n"
        "-2,7,1e3,2024-02-01,2024-02-01T11:30:00,FALSE,,,y\n\n")
    table = readers.read_table(spark, str(tmp_path / "t.csv"))
    assert [t for _, t in table.dtypes] == ["int", "bigint", "double", "date", "timestamp", "boolean",
                                            "string", "string", "string"]
    assert table.count() == 2


def test_broken_csv_is_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,2\nx,3\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.read_table(spark, str(tmp_path / "t.csv"), "csv", "a int, b int").collect()


def test_records(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "é")], "a int, b string")
    path = str(tmp_path / "r.jsonl")
    writers.write_records(df, path)
    back = readers.read_records(spark, path, "a int, b string")
    assert sorted(map(tuple, back.collect())) == [(1, None), (2, "é")]
    (tmp_path / "array.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=1))
    assert readers.read_records(spark, str(tmp_path / "array.json")).count() == 2
    with pytest.raises(ValueError, match="records end"):
        readers.read_records(spark, "data.txt")


def test_documents(spark, tmp_path):
    for name, body in (("a.md", b"one"), ("b.pdf.md", b"bad \xff byte"), ("c.MD", b"x"),
                       ("sub/d.txt", b"four!"), ("e.csv", b"no")):
        target = tmp_path / "docs" / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(body)
    root = str(tmp_path / "docs")
    files = readers.list_documents(spark, root)
    found = {r["key"].rsplit("/", 1)[1]: r["size_bytes"] for r in files.collect()}
    assert found == {"a.md": 3, "b.pdf.md": 10, "d.txt": 5}
    assert "content" not in files.columns
    docs = {r["document_id"]: r["text"] for r in readers.load_text_documents(
        spark, f"{root}/*.md").collect()}
    assert docs == {"a": "one", "b.pdf": "bad � byte"}
    with pytest.raises(PySparkException):
        readers.load_text_documents(spark, f"{root}/*.md", "error").collect()
    with pytest.raises(ValueError, match="no supported"):
        readers.list_documents(spark, root, (".docx",))
    totals = sampling.manifest(files, "bucket", "docs")
    writers.write_manifest(files, totals, str(tmp_path / "manifest"))
    row = spark.read.json(str(tmp_path / "manifest" / "summary")).first()
    assert (row["count"], row["total_size_bytes"], row["bucket"]) == (3, 18, "bucket")
    assert spark.read.parquet(str(tmp_path / "manifest" / "documents")).count() == 3


def test_benchmark(spark, tmp_path):
    body = [{"question": "q", "correct_answers": ["a"], "correct_answer_document_ids": ["d"]}]
    (tmp_path / "b.json").write_text(json.dumps(body))
    row = readers.load_benchmark(spark, str(tmp_path / "b.json")).first()
    assert row["question"] == "q" and row["correct_answer_document_ids"] == ["d"]
    with pytest.raises(ValueError):
        readers.load_benchmark(spark, str(tmp_path / "b.csv"))
    with pytest.raises(FileNotFoundError):
        readers.load_benchmark(spark, str(tmp_path / "missing.json"))


def test_questions_keep_their_position(spark, tmp_path):
    body = [{"question": f"q{i}", "correct_answers": [f"a{i}", "b"] if i % 3 else None, "more": 1}
            for i in range(500)]
    (tmp_path / "b.json").write_text(json.dumps(body, indent=1))
    rows = readers.load_benchmark(spark, str(tmp_path / "b.json")).orderBy("question_id").collect()
    assert [(r.question_id, r.question) for r in rows] == [(i, f"q{i}") for i in range(500)]
    assert rows[1].correct_answers == ["a1", "b"] and rows[0].correct_answers is None
    assert rows[0].correct_answer_document_ids is None
    (tmp_path / "broken.json").write_text("[{")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.load_benchmark(spark, str(tmp_path / "broken.json")).collect()


def test_pattern_and_metric_files(spark, tmp_path):
    for name in ("p1", "p2"):
        (tmp_path / "patterns" / name).mkdir(parents=True)
        (tmp_path / "patterns" / name / "pattern.json").write_text(json.dumps({"name": name}))
        (tmp_path / "models" / name / "metrics").mkdir(parents=True)
        (tmp_path / "models" / name / "metrics" / "metrics.json").write_text('{"r2": 0.5}')
    (tmp_path / "patterns" / "empty").mkdir()
    (tmp_path / "patterns" / "file.txt").write_text("x")
    rows = readers.load_patterns(spark, str(tmp_path / "patterns")).orderBy("directory").collect()
    assert [(r["directory"], json.loads(r["pattern"])["name"]) for r in rows] == [
        ("p1", "p1"), ("p2", "p2")]
    rows = readers.load_model_metrics(spark, str(tmp_path / "models")).collect()
    assert {r["model"] for r in rows} == {"p1", "p2"}


def test_evaluation_folders(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "pattern string, v int")
    writers.write_evaluations(df, str(tmp_path / "e"))
    assert {p.name for p in (tmp_path / "e").iterdir() if p.is_dir()} == {"_folder=a", "_folder=b"}


def test_stream_takes_each_file_once(spark, tmp_path):
    source, index, progress = (str(tmp_path / n) for n in ("in", "index", "progress"))
    docs = spark.createDataFrame([(i, "word " * 30) for i in range(9)], "doc_id long, text string")
    docs.repartition(3).write.parquet(source)

    def run():
        stream = indexing.document_stream(spark, source, "doc_id long, text string", batch_files=2)
        indexing.run_index(stream, index, progress, "c", size=60, dim=16)
        return spark.read.parquet(index)

    first = run()
    n = first.count()
    assert first.select("doc_id").distinct().count() == 9 and n == 27
    assert run().count() == n
    docs.withColumn("doc_id", docs["doc_id"] + 100).coalesce(1).write.mode("append").parquet(source)
    assert run().count() == 2 * n
    steps = indexing.index_progress(spark, index, "c").orderBy("batch").collect()
    assert sum(r["chunks"] for r in steps) == 2 * n and len(steps) == 3
    # The third run had a new file; what it kept goes on from the runs before it.
    assert [r["documents_so_far"] for r in steps][-1] == 18
    assert [r["chunks_so_far"] for r in steps] == [
        sum(r["chunks"] for r in steps[:i + 1]) for i in range(3)]
    # A second source with its own progress adds to the collection, as a plain append does.
    other = str(tmp_path / "other")
    docs.withColumn("doc_id", docs["doc_id"] + 900).coalesce(1).write.parquet(other)
    indexing.run_index(indexing.document_stream(spark, other, "doc_id long, text string"), index,
                       str(tmp_path / "other_progress"), "c", size=60, dim=16)
    assert retrieval.read_index(spark, index, "c").count() == 3 * n
    retrieval.append_index(retrieval.read_index(spark, index, "c").limit(5), index, "c")
    assert retrieval.read_index(spark, index, "c").count() == 3 * n + 5


def test_replayed_batch_keeps_its_totals(spark, tmp_path):
    """A batch that fails after its rows were written, and is done again on restart."""
    source, index, progress = (str(tmp_path / n) for n in ("in", "index", "progress"))
    docs = spark.createDataFrame([(i, "word " * 30) for i in range(8)], "doc_id long, text string")
    docs.repartition(4).write.parquet(source)

    def run():
        stream = indexing.document_stream(spark, source, "doc_id long, text string", batch_files=1)
        indexing.run_index(stream, index, progress, "c", size=60, dim=16)

    run()
    before = sorted(map(tuple, indexing.index_progress(spark, index, "c").collect()))
    assert [r[1] for r in before] == [0, 1, 2, 3] and before[-1][4:] == (8, 24)
    # Forget that the last batch was done: the stream does it again.
    last = max((tmp_path / "progress" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    for check in (tmp_path / "progress" / "commits").glob(f".{last.name}.crc"):
        check.unlink()
    run()
    assert sorted(map(tuple, indexing.index_progress(spark, index, "c").collect())) == before
    assert spark.read.parquet(index).count() == 24


def test_a_file_for_each_of_many_keys(spark, tmp_path):
    path = f"file:{tmp_path}/one plus+one"
    rows = spark.range(3000).select("id", F.concat(F.lit("é "), F.col("id")).alias("text"))
    odd = spark.createDataFrame([(3000, "a"), (3000, "a"), (3001, None)], "id long, text string")
    writers.write_folders(rows.unionByName(odd), path, "id", "text", 8)
    files = {p.relative_to(tmp_path / "one plus+one").as_posix(): p for p in (
        tmp_path / "one plus+one").rglob("*") if p.is_file()}
    # By the tasks themselves: neither check sums nor success marks beside them.
    assert set(files) == {f"id={i}/part-0.txt" for i in range(3002)}
    found = readers.load_patterns(spark, path, "part-*")
    assert not found.inputFiles()
    texts = {r["directory"]: r["pattern"] for r in found.collect()}
    assert len(texts) == 3002 and texts["id=17"] == "é 17\n"
    assert texts["id=3000"] == "a\na\n" and texts["id=3001"] == "\n"


def test_pattern_files_missing_is_an_error(spark, tmp_path):
    (tmp_path / "p").mkdir()
    for path in (tmp_path / "p", tmp_path / "q"):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            readers.load_patterns(spark, f"file:{path}").collect()


def test_quoted_lines_are_taken_in_small_parts(spark, tmp_path, monkeypatch):
    sizes = []
    add = quoted._Split.add
    monkeypatch.setattr(quoted._Split, "add", lambda self, values: (
        sizes.append(len(values)), add(self, values))[1])
    taken = {}

    class Lines:
        def mapInArrow(self, run, schema):
            taken["run"] = run
            return spark.createDataFrame([], schema)

    class Sums:
        def filter(self, condition):
            return self

        def collect(self):
            return []

    monkeypatch.setattr(quoted, "_lines", lambda spark, path: Lines())
    monkeypatch.setattr(quoted, "_split_sums", lambda lines: Sums())
    quoted.records(spark, "x")
    lines = ["h,k"] + [line for i in range(700) for line in (f'{i},"a', f'b{i}"', f"{i},c")]
    batch = pa.RecordBatch.from_pydict({"value": lines, "file": ["f"] * len(lines),
                                        "block": np.zeros(len(lines), np.int64)})
    got = [r for part in taken["run"]([batch]) for r in part.to_pylist()]
    want = [r for i in range(700) for r in (f'{i},"a\nb{i}"', f"{i},c")]
    assert [r["record"] for r in got if r["kind"] == quoted.RECORD] == want
    assert max(sizes) <= quoted.LINES_AT_ONCE

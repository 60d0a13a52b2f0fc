"""Record files as a data source: quotes, broken archives, streams."""

import csv
import io
import random
import zipfile

from pyspark.sql import functions as F

from tidemark.operators import articles
from tidemark.sources import archives
from tidemark.streaming import streams


def zipped(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data)


def load(spark, folder, **options):
    archives.register(spark)
    return spark.read.format("record_files").options(**options).load(str(folder))


def test_ten_thousand_random_records_as_python_reads_them(spark, tmp_path):
    rng = random.Random(5)
    field = lambda: "".join(rng.choice(["a", "bc", '"', "\t", "\n", "\r\n", "", " ", "é", "'", ",", '""']) for _ in range(rng.randint(0, 6)))
    text = io.StringIO()
    writer = csv.writer(text, delimiter="\t")
    for i in range(5000):
        writer.writerow([str(i), *(field() for _ in range(rng.randint(0, 4)))])
    raw = "".join(f"{i}\t" + "\t".join(rng.choice(['x"y', '"q"z', '"a\tb"', "", "w"]) for _ in range(3)) + "\n" for i in range(5000))  # quotes that no writer makes
    (tmp_path / "plain.csv").write_text(text.getvalue(), newline="")
    zipped(tmp_path / "z.zip", one=text.getvalue(), two=raw)
    want = {("plain.csv", ""): text.getvalue(), ("z.zip", "one"): text.getvalue(), ("z.zip", "two"): raw}
    got = {}
    for r in load(spark, tmp_path).orderBy("file", "member", "row").collect():
        got.setdefault((r.file, r.member), []).append(r.fields)
    assert got == {k: list(csv.reader(io.StringIO(v, newline=""), delimiter="\t")) for k, v in want.items()}


def test_broken_archives_give_their_error_and_no_record(spark, tmp_path):
    line = "\t".join(["x"] * 27) + "\n"
    zipped(tmp_path / "a.zip", m=line * 3)
    whole = (tmp_path / "a.zip").read_bytes()
    (tmp_path / "b.zip").write_bytes(whole[:-10])
    (tmp_path / "c.zip").write_bytes(b"")
    with zipfile.ZipFile(tmp_path / "d.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("good", line)
        z.writestr("bad", line * 2)
    broken = bytearray((tmp_path / "d.zip").read_bytes())
    broken[broken.rfind(b"x\tx", 0, broken.find(b"PK\x01\x02"))] ^= 1  # a letter of the second member: its check sum is wrong
    (tmp_path / "d.zip").write_bytes(bytes(broken))
    (tmp_path / "e.zip").write_bytes(whole.replace(b"x", b"x"))
    (tmp_path / "f.csv").write_bytes(b"\xff\xfe" + line.encode() + b"short\tone\n")  # undecodable bytes are left out
    (tmp_path / "_hidden").write_text("x")
    files = load(spark, tmp_path, partition_bytes="100")
    got = {r.file: r for r in articles.snapshot_totals(files, spark.createDataFrame([("a.zip",)], "file string")).collect()}
    assert {k: (r.records, r.full, r.articles, r.error is not None) for k, r in got.items()} == {
        "a.zip": (3, 3, 1, False), "b.zip": (0, 0, 0, True), "c.zip": (0, 0, 0, True), "d.zip": (0, 0, 0, True), "e.zip": (3, 3, 0, False), "f.csv": (2, 1, 0, False),
    }
    assert files.rdd.getNumPartitions() > 2


def test_no_files(spark, tmp_path):
    assert load(spark, tmp_path).count() == 0


def test_stream_takes_files_in_order_of_their_names(spark, tmp_path):
    landed, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    landed.mkdir()

    def poll():
        archives.register(spark)
        s = spark.readStream.format("record_files").load(str(landed)).select("file", F.get("fields", F.lit(0)).alias("x"))
        streams.sink(s, target, check).awaitTermination()
        return sorted((r.file, r.x) for r in spark.read.schema(s.schema).parquet(target).collect())

    zipped(landed / "20240101000000.zip", m="a\n")
    assert poll() == [("20240101000000.zip", "a")]
    zipped(landed / "20240101001500.zip", m="b\n")
    (landed / "20240101003000.zip").write_bytes(b"no")
    assert poll() == [("20240101000000.zip", "a"), ("20240101001500.zip", "b"), ("20240101003000.zip", None)]
    assert len(poll()) == 3

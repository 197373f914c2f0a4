"""One large JSON object read by many tasks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from billflow.sources.payloads import read_truth

NASTY = ['a "quoted" name', "brace } , in", 'ends with },', '}, \\"x\\": {', "{", "comma, ", "日本",
         '"}, "', "line\nbreak", "\\", ":{"]


def records(n):
    rng = random.Random(n)
    return {f'bill "{i}" {rng.choice(NASTY)}.jpg' if i % 9 == 0 else f"bill_{i}.jpg": {
        "vendor_name": rng.choice(NASTY) * rng.randint(0, 3), "invoice_number": f"I{i}",
        "date": "2024-01-01", "total_amount": rng.choice([i / 4, f"{i}.5 INR", f" {i}"]),
        "tax_amount": None, "gstin": rng.choice(NASTY)} for i in range(n)}


def number(value):
    return None if value is None else float(str(value).split()[0])


@pytest.mark.parametrize("indent, split", [(None, 97), (None, 1500), (3, 400), (0, 1 << 20)])
def test_members_at_every_cut(spark, tmp_path, indent, split):
    truth = records(60 if split < 100 else 400)
    (tmp_path / "t.json").write_text(json.dumps(truth, indent=indent, ensure_ascii=False))
    (tmp_path / "empty.json").write_text("{ }")
    rows = read_truth(spark, str(tmp_path), split_bytes=split)
    assert split > 1500 or rows.rdd.getNumPartitions() > 5
    got = {r.file: (r.vendor_name, r.total_amount, r.gstin, r.error) for r in rows.collect()}
    assert rows.count() == len(truth)
    assert got == {k: (v["vendor_name"], number(v["total_amount"]), v["gstin"], None)
                   for k, v in truth.items()}


def test_broken_members_are_rows(spark, tmp_path):
    good = json.dumps({"vendor_name": "V", "total_amount": 1})
    (tmp_path / "t.json").write_text(
        '{"a": %s, "b": {oops}, "c": %s, "d": {"vendor_name": "x" "y"}, "e": %s}' % ((good,) * 3))
    got = {r.file: r.error for r in read_truth(spark, str(tmp_path), split_bytes=20).collect()}
    assert [k for k in sorted(got) if got[k] is None] == ["a", "c", "e"]
    assert set(got) == {"a", "b", "c", "d", "e"} and "broken" in got["b"]
    lines = tmp_path / "lines"
    spark.createDataFrame([('{"a": %s}' % good,), ("{no",), ('{"b": 7}',)], "value string").write.text(
        str(lines))
    rows = read_truth(spark, str(lines), whole_file=False).orderBy(F.col("file").asc_nulls_last())
    assert [(r.file, r.vendor_name, r.error) for r in rows.collect()] == [
        ("a", "V", None), ("b", None, "record is no JSON object"),
        (None, None, "line is no JSON object")]


def test_one_file_of_ordered_ranges(spark, tmp_path, monkeypatch):
    """Many tasks write an ordered object; the copy makes one file of their ranges, in order."""
    from checks import queries
    monkeypatch.setattr(queries, "fresh_dir", lambda spark, purpose: str(tmp_path / purpose))
    lines = spark.range(5000).select(F.concat(F.lit("line "), "id").alias("value"), "id").repartitionByRange(
        5, "id").sortWithinPartitions("id").select("value")
    queries._one_file(spark, lines, str(tmp_path / "one"))
    assert len(list((tmp_path / "ranges").glob("part-*"))) > 1
    file, = (tmp_path / "one").iterdir()
    assert file.read_text().splitlines() == [f"line {i}" for i in range(5000)]


def test_a_range_reads_little_behind_itself(tmp_path):
    """The member that a range ends in is short; a mebibyte behind each range would be read many times over."""
    from billflow.sources.members import MembersReader
    path = tmp_path / "t.json"
    path.write_text(json.dumps({f"bill_{i}": {"n": i} for i in range(200_000)}))
    reader, read = MembersReader(str(path), 1 << 16), []

    class File:
        def __init__(self, file):
            self.file, self.seek = file, file.seek

        def read(self, n):
            data = self.file.read(n)
            read.append(len(data))
            return data
    with open(path, "rb") as file:
        rows = [r for part in reader.partitions() for r in reader._members(File(file), part)]
    assert len(rows) == 200_000 and not any(r[2] for r in rows)
    assert sum(read) < 1.2 * path.stat().st_size

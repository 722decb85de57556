"""Versions, claims, page files and split files: two runs in a row, runs at once, runs that break off."""

import csv
import json
import sys
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark import cloudpickle

from leafcut.operators import classify
from leafcut.sources import files, readers, sinks, store

# Workers can't import tests, so what they need of this one travels with the call.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
TYPES = "type_id string, type_ord int"


def vectors(spark, *rows):
    return spark.createDataFrame([(t, i, [float(v)]) for i, (t, v) in enumerate(rows)], "type_id string, ord int, vec array<double>")


def held(spark, path, types, version=None):
    out = {}
    for r in readers.prototypes(spark, path, types, version).orderBy("type_id", "ord").collect():
        out.setdefault(r.type_id, []).append(r.vec[0])
    return out


def test_prototypes_grow_run_by_run(spark, tmp_path):
    types, path = spark.createDataFrame([("a", 0), ("b", 1)], TYPES), str(tmp_path / "store")
    assert held(spark, path, types) == {}
    assert readers.save_prototypes(spark, path, vectors(spark, *(("a", i) for i in range(15)))) == (1, 15, 15)
    pinned = readers.prototypes(spark, path, types)
    assert readers.save_prototypes(spark, path, vectors(spark, *(("a", 100 + i) for i in range(10)), ("b", 7), ("gone", 1))) == (2, 12, 22)
    assert held(spark, path, types) == {"a": [*map(float, range(5, 15)), *map(float, range(100, 110))], "b": [7.0]}
    assert pinned.count() == 15 and held(spark, path, types, 1) == {"a": list(map(float, range(15)))}
    # More than twenty new ones of a type push out all older ones.
    assert readers.save_prototypes(spark, path, vectors(spark, *(("a", i) for i in range(200, 230)))) == (3, 20, 22)
    assert held(spark, path, types)["a"] == list(map(float, range(210, 230)))


def test_a_plain_file_is_where_versions_start(spark, tmp_path):
    types, path = spark.createDataFrame([("a", 0)], TYPES), tmp_path / "p.json"
    path.write_text(json.dumps({"a": [[1.0], [2.0]], "unknown": [[9.0]]}))
    assert readers.save_prototypes(spark, str(path), vectors(spark, ("a", 3))) == (1, 1, 4)
    assert held(spark, str(path), types) == {"a": [1.0, 2.0, 3.0]} and json.loads(path.read_text())["a"] == [[1.0], [2.0]]
    # Also in the file itself, which is read while its successor is written.
    known = readers.prototypes(spark, str(path), types)
    assert readers.write_prototypes(known, str(tmp_path / "out")) == 3
    again = readers.prototypes(spark, str(tmp_path / "out"), types)
    assert readers.write_prototypes(again, str(tmp_path / "out")) == 3 and held(spark, str(tmp_path / "out"), types) == {"a": [1.0, 2.0, 3.0]}


def test_a_run_that_ends_before_publishing_changes_nothing(spark, tmp_path, monkeypatch):
    types, path = spark.createDataFrame([("a", 0)], TYPES), str(tmp_path / "store")
    readers.save_prototypes(spark, path, vectors(spark, ("a", 1)))
    with monkeypatch.context() as m:
        m.setattr(store, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            readers.save_prototypes(spark, path, vectors(spark, ("a", 2)))
    assert held(spark, path, types) == {"a": [1.0]} and store.latest(spark, path) == 1
    assert readers.save_prototypes(spark, path, vectors(spark, ("a", 3))) == (2, 1, 2)


def test_a_run_that_comes_second_builds_on_the_first(spark, tmp_path, monkeypatch):
    types, path, real, once = spark.createDataFrame([("a", 0)], TYPES), str(tmp_path / "store"), store.publish, []

    def late(*args):
        if not once:
            once.append(1)
            readers.save_prototypes(spark, path, vectors(spark, ("a", 1)))
        return real(*args)

    monkeypatch.setattr(store, "publish", late)
    assert readers.save_prototypes(spark, path, vectors(spark, ("a", 2))) == (2, 1, 2)
    assert held(spark, path, types) == {"a": [1.0, 2.0]}


def test_claims_are_exclusive(spark, tmp_path):
    (tmp_path / "run_v2").mkdir()
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: store.claim(spark, str(tmp_path), "run"), range(12)))
    assert sorted(int(x.rpartition("_v")[2]) for x in got) == [1, *range(3, 14)]


def test_taught_are_the_last_of_each_known_type(spark):
    rows = [("d", i, "a" if i < 30 else "x", True, [float(i)]) for i in range(40)] + [("e", 1, "a", True, [99.0]), ("e", 2, "a", False, [1.0])]
    df = spark.createDataFrame(rows, "doc_id string, segment_index int, document_type_id string, may_teach boolean, centroid array<double>")
    kept = classify.keep_prototypes(vectors(spark, ("b", 5)), classify.taught(df, spark.createDataFrame([("a", 0)], TYPES)))
    got = [(r.type_id, r.ord, r.vec[0]) for r in kept.orderBy("type_id", "ord").collect()]
    assert got == [("a", k, v) for k, v in enumerate([*map(float, range(11, 30)), 99.0], 1)] + [("b", 1, 5.0)]


# Page files: lines are pages, and every page that is opened is noted in a file beside.
class Lines:
    def __init__(self, stream, opened):
        text = stream.read().decode()
        if text == "broken":
            raise ValueError("not a page file")
        self.lines, self.opened = [] if text == "empty" else text.splitlines(), opened

    def __len__(self):
        return len(self.lines)

    def page(self, number, wanted):
        with open(self.opened, "a") as f:
            f.write(f"{number} {' '.join(sorted(wanted))}\n")
        if self.lines[number - 1] == "bad":
            raise ValueError(f"page {number} is bad")
        return {"text": self.lines[number - 1], "width": 600.0, "height": 800.0, "bands": {"0.12": {"header": "h", "footer": None}}, "drawing_count": 0, "image_count": 0, "image_area": 0.0, "image_infos": []}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    for name, body in (("long.pdf", "\n".join(f"p{i}" for i in range(1, 301))), ("b.PDF", "x\nbad\nz"), ("c.pdf", "broken"), ("none.pdf", "empty"), ("sub/b.pdf", "q\nr"), ("note.txt", "n")):
        (tmp_path / "in" / name).write_text(body)
    return tmp_path / "in"


def decoder(folder):
    log = str(folder / "opened.log")
    return lambda stream: Lines(stream, log)


def test_pages_by_file_and_range(spark, folder):
    found = files.listing(spark, [str(folder)], recursive=True)
    assert found.columns == ["doc_id", "path", "length"] and sorted(r.doc_id for r in found.collect()) == ["b", "c", "long", "none", "sub/b"]
    counts = files.counted(found, decoder(folder))
    decoded = files.pages(counts, decoder(folder), max_pages=10, columns=["text"], pages_per_task=4)
    assert decoded.columns == ["doc_id", "page_num", "text", "error"]
    rows = files.whole(decoded).orderBy("doc_id", "page_num").collect()
    assert [(r.doc_id, r.page_num, r.text) for r in rows] == [*(("long", i, f"p{i}") for i in range(1, 11)), ("sub/b", 1, "q"), ("sub/b", 2, "r")]
    bad = {r.doc_id: r.error for r in files.failures(counts, decoded).collect()}
    assert bad == {"c": "ValueError: not a page file", "none": "no pages", "b": "ValueError: page 2 is bad"}
    (folder / "opened.log").unlink()
    long = files.pages(counts.filter("doc_id = 'long'"), decoder(folder), max_pages=10)
    assert long.count() == 10 and (folder / "opened.log").read_text().count("\n") == 10
    whole = files.pages(counts.filter("doc_id = 'long'"), decoder(folder))
    assert whole.drop("error").schema == spark.createDataFrame([], files.RAW_PAGES).schema and whole.count() == 300 and whole.rdd.getNumPartitions() > 1


def test_a_bound_on_pages_reaches_the_source(spark, folder):
    spark.dataSource.register(files.page_source(decoder(folder)))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    (folder / "b.PDF").unlink()
    (folder / "c.pdf").unlink()
    df = spark.read.format("pages").option("pages_per_task", 4).load(str(folder)).filter("page_num <= 10 AND page_num > 2")
    assert sorted(r.page_num for r in df.collect()) == list(range(3, 11)) and (folder / "opened.log").read_text().count("\n") == 10


def test_files_that_would_be_one_document_are_refused(spark, folder):
    with pytest.raises(ValueError, match="would both be document 'b'"):
        files.listing(spark, [str(folder), str(folder / "sub")])


# Split files.
class Stop(BaseException):
    pass


def split(stream, ranges):
    lines = stream.read().decode().splitlines()
    for a, b in ranges:
        if "stop" in lines[a - 1 : b]:
            raise Stop
        if "bad" in lines[a - 1 : b]:
            raise ValueError("a bad page")
        yield "\n".join(lines[a - 1 : b]).encode()


def summary(spark, *docs):
    rows = [(d, f"segment_{i:03d}_pp{a}-{b}.pdf", a, b) for d, ranges in docs for i, (a, b) in enumerate(ranges, 1)]
    return spark.createDataFrame(rows, "pdf_id string, output_file string, start_page int, end_page int")


def test_segments_become_files_and_a_log(spark, folder, tmp_path):
    found = files.listing(spark, [str(folder)], recursive=True)
    want = summary(spark, ("long", [(1, 2), (3, 300)]), ("b", [(1, 1), (2, 3)]), ("sub/b", [(1, 2)]))
    out = [sinks.write_segments(want, found, split, str(tmp_path / "out")) for _ in range(2)]
    assert [x.rpartition("/")[2] for x in out] == ["run_v1", "run_v2"]
    at = tmp_path / "out" / "run_v1"
    assert sorted(x.relative_to(at).as_posix() for x in at.rglob("*.pdf")) == ["long/segment_001_pp1-2.pdf", "long/segment_002_pp3-300.pdf", "sub/b/segment_001_pp1-2.pdf"]
    assert (at / "long/segment_001_pp1-2.pdf").read_text() == "p1\np2" and (at / "sub/b/segment_001_pp1-2.pdf").read_text() == "q\nr"
    log = {(r.pdf_filename, r.status) for r in sinks.batch_log(spark, str(at)).collect()}
    assert log == {("long.pdf", "OK"), ("b.PDF", "FAILED (exception: a bad page)"), ("b.pdf", "OK")} and (at / "_SUCCESS").exists() and not (at / "_attempts").exists()


def test_the_log_survives_a_task_that_fails(spark, folder, tmp_path):
    (folder / "d.pdf").write_text("a\nstop")
    found = files.listing(spark, [str(folder)])
    want = summary(spark, *((x, [(1, 1)]) for x in ("b", "long")), ("d", [(1, 2)])).coalesce(1)
    with pytest.raises(Exception, match="Stop"):
        sinks.write_segments(want, found, split, str(tmp_path / "out"))
    at = tmp_path / "out" / "run_v1"
    assert (at / "_ABORTED").exists() and not (at / "_SUCCESS").exists() and not (at / "d").exists()
    rows = [r for x in (at / "batch_run_log").iterdir() for r in csv.DictReader(x.open())]
    assert {r["pdf_filename"] for r in rows} <= {"b.PDF", "long.pdf"} and all(r["status"] == "OK" for r in rows)
    # Whatever appeared is whole, and a run after it claims a folder of its own.
    assert all((at / d).is_dir() == any(r["output_dir"].endswith(f"/{d}") for r in rows) for d in ("b", "long"))
    assert sinks.write_segments(want.filter("pdf_id <> 'd'"), found, split, str(tmp_path / "out")).endswith("run_v2")

import os
from pathlib import Path

import pytest

from layerworks.operators.chunk import to_gold_chunks
from layerworks.plans.arrivals import DocumentCollection
from layerworks.plans.documents import silver_documents
from layerworks.queries.documents import CONFIG
from layerworks.sources.files import compare_listings, list_files, read_binary_batch, read_listed, to_bronze


@pytest.fixture
def place(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def collection(place, **options):
    config = {**CONFIG, "source": {"path": str(place / "in"), "path_glob_filter": "*"}}
    return DocumentCollection(str(place / "out"), config, **options)


def write(place, at=None, **texts):
    for name, text in texts.items():
        path = place / "in" / f"{name}.md"
        path.write_text(text)
        if at is not None:
            os.utime(path, (at, at))


def silver(rows):
    return sorted((r.document_id, r.extracted_text, r.source_type, r.metadata["file_path"]) for r in rows.collect())


def rebuilt(spark, place):
    """Silver and Gold of the whole folder, made anew."""
    whole = silver_documents(to_bronze(read_binary_batch(spark, str(place / "in"))))
    chunks = to_gold_chunks(whole, CONFIG)
    return silver(whole), sorted(tuple(r) for r in chunks.collect())


def assert_as_rebuilt(spark, place, docs):
    whole, chunks = rebuilt(spark, place)
    assert silver(docs.silver(spark)) == whole
    assert sorted(tuple(r) for r in docs.gold(spark).select(*docs.gold(spark).columns).collect()) == chunks


def test_arrivals_changes_and_removals_equal_a_rebuild(spark, place):
    docs = collection(place)
    write(place, a="# one\n\ntext", b="# two\n\ntext", c="# one\n\ntext")
    assert docs.refresh(spark) == {"added": 3, "changed": 0, "removed": 0}
    assert_as_rebuilt(spark, place, docs)
    write(place, d="# two\n\ntext", e="# five\n\nsomething")
    assert docs.refresh(spark) == {"added": 2, "changed": 0, "removed": 0}
    assert_as_rebuilt(spark, place, docs)
    # A changed text, one that becomes a copy, and one that comes back.
    write(place, a="# one\n\nother text", at=2_000_000_000)
    write(place, e="# two\n\ntext", at=2_000_000_000)
    assert docs.refresh(spark) == {"added": 0, "changed": 2, "removed": 0}
    assert_as_rebuilt(spark, place, docs)
    (place / "in" / "b.md").unlink()
    (place / "in" / "c.md").unlink()
    assert docs.refresh(spark) == {"added": 0, "changed": 0, "removed": 2}
    assert_as_rebuilt(spark, place, docs)
    write(place, c="# one\n\ntext", a="# one\n\ntext", at=2_000_000_100)
    assert docs.refresh(spark) == {"added": 1, "changed": 1, "removed": 0}
    assert_as_rebuilt(spark, place, docs)
    assert docs.refresh(spark) == {"added": 0, "changed": 0, "removed": 0}
    assert [r.change for r in docs.commits(spark).orderBy("change").collect()] == [1, 2, 3, 4, 5]


def test_old_files_are_neither_read_extracted_nor_hashed_again(spark, place):
    log = place / "parsed.txt"

    def parse(content):
        with open(log, "a") as out:
            out.write(content.decode() + "\n")
        return content.decode()

    docs = collection(place, parsers={"md": parse})
    write(place, at=1_000_000_000, a="first", b="second")
    docs.refresh(spark)
    write(place, at=1_000_000_500, c="third", d="first")
    docs.refresh(spark)
    assert sorted(log.read_text().split()) == ["first", "first", "second", "third"]
    # Each change holds the rows of its own files.
    for change, names in ((1, {"a", "b"}), (2, {"c", "d"})):
        rows = spark.read.parquet(f"{place}/out/extracted/change={change}").collect()
        assert {Path(r.file_path).stem for r in rows} == names
    added = spark.read.parquet(f"{place}/out/silver/change=2")
    assert {r.extracted_text for r in added.collect()} <= {"third", "first"}


def test_only_retracted_documents_leave_gold(spark, place):
    docs = collection(place)
    write(place, a="# A\n\nalpha", b="# B\n\nbeta")
    docs.refresh(spark)
    write(place, b="# B\n\nbeta two", at=2_000_000_000)
    docs.refresh(spark)
    removed = spark.read.parquet(f"{place}/out/removed/change=2").collect()
    assert len(removed) == 1
    assert sorted(r.chunk_text for r in docs.gold(spark).collect()) == ["A\nalpha", "B\nbeta two"]
    assert spark.read.parquet(f"{place}/out/gold/change=2").count() == 1


def test_a_touched_file_with_the_same_text_moves_nothing(spark, place):
    docs = collection(place)
    write(place, a="same", at=1_000_000_000)
    docs.refresh(spark)
    write(place, a="same", at=2_000_000_000)
    assert docs.refresh(spark)["changed"] == 1
    assert spark.read.parquet(f"{place}/out/moved/change=2").count() == 0
    assert [r.extracted_text for r in docs.silver(spark).collect()] == ["same"]


def test_a_change_that_failed_is_done_again(spark, place, monkeypatch):
    docs = collection(place)
    write(place, a="one")
    docs.refresh(spark)
    write(place, b="two")
    with monkeypatch.context() as patch:
        patch.setattr("layerworks.plans.arrivals.to_gold_chunks", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            docs.refresh(spark)
    assert [r.extracted_text for r in docs.silver(spark).collect()] == ["one"]
    write(place, c="three")
    assert docs.refresh(spark)["added"] == 2
    assert_as_rebuilt(spark, place, docs)


def test_files_without_a_text(spark, place):
    docs = collection(place)
    write(place, a="text")
    (place / "in" / "b.bin").write_bytes(b"\x00")
    (place / "in" / "empty.md").write_bytes(b"")  # Spark's readers pass over it
    docs.refresh(spark)
    assert [(Path(r.file_path).name, r._corrupt) for r in docs.quarantine(spark).collect()] == [("b.bin", "unsupported_type")]
    assert len(silver(docs.silver(spark))) == 1
    (place / "in" / "b.bin").unlink()
    docs.refresh(spark)
    assert docs.quarantine(spark).count() == 0
    assert_as_rebuilt(spark, place, docs)


def test_before_the_first_refresh_and_an_empty_folder(spark, place):
    docs = collection(place)
    assert docs.silver(spark).count() == docs.gold(spark).count() == docs.quarantine(spark).count() == 0
    assert docs.refresh(spark) == {"added": 0, "changed": 0, "removed": 0}


def test_listings_are_compared_by_path_time_and_length(spark, place):
    write(place, at=1_000_000_000, same="x", longer="x", later="x", gone="x")
    before = spark.createDataFrame(list_files(spark, str(place / "in")).collect())
    write(place, at=1_000_000_000, longer="xx", new="x")
    write(place, at=1_500_000_000, later="y")
    (place / "in" / "gone.md").unlink()
    out = compare_listings(before, list_files(spark, str(place / "in"))).collect()
    assert {Path(r.file_path).stem: r.status for r in out} == {"same": "same", "longer": "changed", "later": "changed", "gone": "removed", "new": "added"}


def test_files_as_new_as_the_listed_ones_are_left_out(spark, place):
    write(place, at=1_000_000_000, old="x")
    write(place, at=1_500_000_000, a="x", b="x")
    listed = list_files(spark, str(place / "in"))
    one = listed.where("file_path like '%a.md'")
    assert [Path(r.path).stem for r in read_listed(spark, str(place / "in"), one).collect()] == ["a"]
    newer = listed.where("file_path not like '%old.md'")
    assert sorted(Path(r.path).stem for r in read_listed(spark, str(place / "in"), newer).collect()) == ["a", "b"]
    assert read_listed(spark, str(place / "in"), listed.where("false")).count() == 0

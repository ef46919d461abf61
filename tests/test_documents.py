import fixtures
import pytest
from pyspark.sql import functions as F

from layerworks.config import chunk_strategy, load_parsing_config, parse_yaml_config
from layerworks.operators.chunk import chunkless_documents, to_gold_chunks
from layerworks.operators.extract import add_extracted_text, join_parts, quarantined_documents
from layerworks.plans.datasets import publish_all
from layerworks.plans.documents import (
    DOCUMENT_TABLES,
    bronze_documents,
    document_datasets,
    ingest_documents,
    silver_documents,
)
from layerworks.plans.tables import drop_table, overwrite_table
from layerworks.sources.files import read_binary, to_bronze


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, content in files.items():
        data = content.encode() if isinstance(content, str) else content
        (folder / name.replace("__", ".")).write_bytes(data)
    return str(folder)


@pytest.fixture
def folder(tmp_path):
    return write(
        tmp_path / "docs",
        engineering_guide__md=fixtures.ENGINEERING_GUIDE,
        sales_policy__md=fixtures.SALES_POLICY,
    )


def texts_by_file(gold, silver):
    path = F.element_at(F.split(F.col("metadata")["file_path"], "/"), -1)
    names = silver.select("document_id", path.alias("name"))
    found = {}
    for row in gold.join(names, "document_id").orderBy("name", "chunk_index").collect():
        found.setdefault(row.name, []).append(row.chunk_text)
    return found


EXPECTED = {
    "engineering_guide.md": fixtures.GUIDE_CHUNKS,
    "sales_policy.md": fixtures.POLICY_CHUNKS,
}


def test_layers_step_by_step(spark, folder, table_names):
    config = parse_yaml_config(fixtures.PARSING.format(path=folder, mode="batch"))
    bronze = ingest_documents(spark, config, table_names("bronze"))
    assert dict(bronze.dtypes) == {
        "file_path": "string", "binary_content": "binary", "ingest_timestamp": "timestamp",
        "_corrupt": "string",
    }
    silver = overwrite_table(silver_documents(bronze), table_names("silver"))
    assert dict(silver.dtypes) == {
        "document_id": "string", "extracted_text": "string", "source_type": "string",
        "metadata": "map<string,string>",
    }
    gold = overwrite_table(to_gold_chunks(silver, config), table_names("gold"))
    assert texts_by_file(gold, silver) == EXPECTED
    assert {(r.allowed_roles, r.department) for r in gold.collect()} == {("analyst,manager", "engineering")}
    assert dict(gold.dtypes)["chunk_index"] == "int"
    assert gold.select("chunk_id").distinct().count() == 5


@pytest.mark.parametrize("mode", ["batch", "autoloader"])
def test_layers_as_declared_datasets(spark, folder, tmp_path, mode):
    for name in DOCUMENT_TABLES:
        drop_table(spark, name)
    (tmp_path / "parsing.yaml").write_text(fixtures.PARSING.format(path=folder, mode=mode))
    config = load_parsing_config(spark, str(tmp_path))
    calls = spark.sparkContext.accumulator(0)

    def parse(content):
        calls.add(1)
        return content.decode()

    datasets = document_datasets(config, str(tmp_path / "checkpoint"), {"pdf": parse})
    assert [dataset.name for dataset in datasets] == list(DOCUMENT_TABLES)
    assert (datasets[0].checkpoint is None) == (mode == "batch")
    metrics = publish_all(spark, datasets)
    assert metrics["silver_docs"] == {"rows": 2, "has_extracted_text": 0}
    assert metrics["gold_chunks"] == {"rows": 5}
    assert texts_by_file(spark.table("gold_chunks"), spark.table("silver_docs")) == EXPECTED
    # A second arrival: a file without a text, one with a parser, and a copy.
    write(tmp_path / "docs", deck__pptx="p", new__pdf="new words", copy__pdf="new words")
    assert publish_all(spark, datasets)["silver_docs"] == {"rows": 5, "has_extracted_text": 1}
    (row,) = spark.table("quarantined_docs").collect()
    assert (row.file_path.rsplit("/", 1)[1], row._corrupt) == ("deck.pptx", "no_parser:pptx")
    assert spark.table("silver_docs").count() == 3
    assert calls.value == 2
    publish_all(spark, datasets)
    # A stream extracts a file once; a batch starts again.
    assert calls.value == (2 if mode == "autoloader" else 4)
    for name in DOCUMENT_TABLES:
        drop_table(spark, name)


def test_odd_files(spark, tmp_path):
    folder = write(
        tmp_path / "odd",
        empty__md="", copy_of_empty__md=" \n", headings__md="# A\n## B\n", data__bin="x",
        deck__PPTX="p", broken__md=b"bad \xff byte", crlf__md="# T\r\nx\r\ny",
        glued__MARKDOWN="連絡先a@b.co です", copy1__md="same", copy2__md="same\n\n",
    )
    bronze = to_bronze(read_binary(spark, folder))
    extracted = add_extracted_text(bronze)
    name = F.element_at(F.split("file_path", "/"), -1)
    reasons = {row.name: row._corrupt for row in quarantined_documents(extracted).select(name.alias("name"), "_corrupt").collect()}
    assert reasons == {"data.bin": "unsupported_type", "deck.PPTX": "no_parser:pptx"}
    silver = silver_documents(bronze).cache()
    got = sorted(row.extracted_text for row in silver.collect())
    # The letters before the address belong to it: they are word characters.
    assert got == sorted(
        ["", "# A\n## B", "bad � byte", "# T\r\nx\r\ny", "[REDACTED_EMAIL] です", "same"]
    )
    config = parse_yaml_config(fixtures.PARSING.format(path=folder, mode="batch"))
    chunks = sorted(row.chunk_text for row in to_gold_chunks(silver, config).collect())
    assert chunks == sorted(["bad � byte", "T\nx\ny", "[REDACTED_EMAIL] です", "same"])
    assert chunkless_documents(silver, config).count() == 2


def test_parsers_plug_in_by_type(spark, tmp_path):
    folder = write(
        tmp_path / "parsed", a__pdf="one|two", b__pptx="x", c__md="plain", d__pdf="||last", e__txt="t"
    )

    def fail(content):
        raise RuntimeError("cannot read")

    parsers = {
        "pdf": lambda data: join_parts(data.decode().split("|"), keep_empty=True),
        "pptx": fail,
    }
    rows = add_extracted_text(to_bronze(read_binary(spark, folder)), parsers).collect()
    by_name = {row.file_path.rsplit("/", 1)[1]: row for row in rows}
    assert by_name["a.pdf"].extracted_text == "one\n\ntwo"
    assert by_name["b.pptx"]._corrupt == "parse_error:RuntimeError: cannot read"
    assert by_name["b.pptx"].extracted_text is None
    assert by_name["c.md"].extracted_text == "plain"
    assert by_name["d.pdf"].extracted_text == "last"
    assert by_name["e.txt"]._corrupt == "unsupported_type"


def test_parser_results_are_made_safe(spark):
    rows = [("a.pdf", b"1"), ("b.pdf", b"2"), ("c.pdf", None)]
    bronze = spark.createDataFrame(rows, "file_path string, binary_content binary")
    parsers = {"pdf": lambda data: None if data == b"1" else "x\ud800"}
    got = add_extracted_text(bronze, parsers).select("extracted_text", "_corrupt").collect()
    assert [tuple(row) for row in got] == [("", None), ("x?", None), (None, "null_content")]


def test_a_parser_slot_holds_few_texts(spark):
    """Of a batch of files, the texts found so far do not pile up in Python."""
    rows = [(f"{i}.pdf", b"x") for i in range(40)]
    bronze = spark.createDataFrame(rows, "file_path string, binary_content binary").coalesce(1)

    def grown(data):
        with open("/proc/self/statm") as file:
            pages = file.read().split()[1]
        return f"{pages} {'x' * (4 << 20)}"

    texts = add_extracted_text(bronze, {"pdf": grown}).select("extracted_text").collect()
    pages = [int(row.extracted_text.split(" ", 1)[0]) for row in texts]
    assert len(pages) == 40 and (max(pages) - min(pages)) * 4096 < 100 << 20


def test_join_parts():
    assert join_parts(["a", "", None, "b"]) == "a\n\nb"
    assert join_parts(["a", None, "b"], keep_empty=True) == "a\n\n\n\nb"


def test_glob_and_modes(spark, folder):
    assert read_binary(spark, folder, path_glob_filter="sales*").count() == 1
    with pytest.raises(ValueError, match="batch, autoloader"):
        read_binary(spark, folder, "other")
    config = {"source": {"path": folder, "mode": "autoloader"}}
    assert bronze_documents(spark, config).isStreaming
    with pytest.raises(ValueError, match="checkpoint"):
        ingest_documents(spark, config, "unused")
    with pytest.raises(ValueError, match="checkpoint"):
        document_datasets(config)


def test_strategy_lookup():
    chunking = {"md": {"strategy": "markdown_header"}, "pdf": None, "default": {"max_chars": 5}}
    assert chunk_strategy("md", {"chunking": chunking}) == {"strategy": "markdown_header"}
    assert chunk_strategy("pdf", {"chunking": chunking}) == {"max_chars": 5}
    assert chunk_strategy("odd", {"chunking": chunking}) == {"max_chars": 5}
    assert chunk_strategy("odd", {}) == {"strategy": "paragraph", "max_chars": 1000, "overlap": 100}

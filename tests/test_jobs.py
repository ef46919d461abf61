import fixtures

from jobs import run_documents, run_feeds
from layerworks.queries.feeds import CLIENT_A, CLIENT_B


def test_feeds_job(spark, tmp_path, capsys):
    for client, csv, text in [
        ("company_a", fixtures.CLIENT_A_CSV, CLIENT_A),
        ("company_b", fixtures.CLIENT_B_CSV, CLIENT_B),
    ]:
        (tmp_path / client).mkdir()
        (tmp_path / client / "x.csv").write_text(csv)
        located = text.replace("file_format: csv", f"file_format: csv\n  path: {tmp_path / client}")
        (tmp_path / f"{client}.yaml").write_text(located)
    spark.sql("CREATE SCHEMA IF NOT EXISTS jobs_test")
    run_feeds.run(spark, str(tmp_path), ["company_a", "company_b"], "jobs_test.")
    shown = capsys.readouterr().out
    assert "jobs_test.silver_cdm {'rows': 10}" in shown
    assert spark.table("jobs_test.silver_cdm").count() == 10
    spark.sql("DROP SCHEMA jobs_test CASCADE")


def test_documents_job(spark, tmp_path, capsys):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "guide.md").write_text(fixtures.ENGINEERING_GUIDE)
    (docs / "deck.pdf").write_bytes(b"%PDF")
    parsing = fixtures.PARSING.format(path=docs, mode="autoloader")
    (tmp_path / "parsing.yaml").write_text(parsing)
    spark.sql("CREATE SCHEMA IF NOT EXISTS jobs_test")
    run_documents.run(spark, str(tmp_path), str(tmp_path / "checkpoint"), "jobs_test.")
    shown = capsys.readouterr().out
    assert "no_parser:pdf" in shown and "jobs_test.gold_chunks {'rows': 3}" in shown
    # A second run takes only the new file and rebuilds the layers above.
    (docs / "policy.md").write_text(fixtures.SALES_POLICY)
    run_documents.run(spark, str(tmp_path), str(tmp_path / "checkpoint"), "jobs_test.")
    assert spark.table("jobs_test.bronze_docs").count() == 3
    assert spark.table("jobs_test.gold_chunks").count() == 5
    spark.sql("DROP SCHEMA jobs_test CASCADE")


def test_documents_job_follows_a_folder(spark, tmp_path, capsys):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "guide.md").write_text(fixtures.ENGINEERING_GUIDE)
    (docs / "deck.pdf").write_bytes(b"%PDF")
    (tmp_path / "parsing.yaml").write_text(fixtures.PARSING.format(path=docs, mode="batch"))
    layers = str(tmp_path / "layers")
    run_documents.follow(spark, str(tmp_path), layers)
    shown = capsys.readouterr().out
    assert "files {'added': 2, 'changed': 0, 'removed': 0}" in shown and "no_parser:pdf" in shown
    (docs / "deck.pdf").unlink()
    (docs / "policy.md").write_text(fixtures.SALES_POLICY)
    run_documents.follow(spark, str(tmp_path), layers)
    shown = capsys.readouterr().out
    assert "files {'added': 1, 'changed': 0, 'removed': 1}" in shown and "no_parser" not in shown

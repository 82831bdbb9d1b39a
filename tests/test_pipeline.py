from collections import Counter
from dataclasses import replace
from datetime import date
from functools import partial
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from basketflow.operators.validation import valid_rows
from basketflow.plans import pipeline
from basketflow.plans.reuse import Reuse
from basketflow.settings import InputPaths, Limits, Scoring
from basketflow.shared import as_table, new_path, shared_folder
from basketflow.sinks.writers import flatten_arrays
from querybook.fixtures import view
from tests.compare import oracle_connection, oracle_rows

FOLDER = "/root/testdata/sf0.001"
INGESTION = ["rapport_qualite", "rejets_transactions", "rejets_users", "rejets_products", "rejets_merchants"]
TRANSFORMATION = [*INGESTION, "transactions_enrichies", "transactions_suspectes"]
EVERYTHING = [
    *TRANSFORMATION,
    "kpi_marchands",
    "cohortes_retention",
    "meilleure_cohorte_3m",
    "top10_produits",
    "ca_categorie_region",
    "ca_paiement_periode",
]


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    paths = InputPaths.under(str(tmp_path_factory.mktemp("inputs")))
    view(spark, FOLDER, "transactions").write.option("header", True).csv(paths.transactions)
    view(spark, FOLDER, "users").write.json(paths.users)
    view(spark, FOLDER, "products").write.parquet(paths.products)
    view(spark, FOLDER, "merchants").write.option("header", True).csv(paths.merchants)
    return paths


@pytest.mark.parametrize(
    ("step", "names"),
    [("ingestion", INGESTION), ("transformation", TRANSFORMATION), ("analytics", EVERYTHING)],
)
def test_each_step_includes_the_earlier(spark, inputs, step, names):
    assert list(pipeline.build_outputs(pipeline.read_inputs(spark, inputs), step)) == names


def test_full_run_writes_what_the_sql_gives(spark, inputs, tmp_path):
    from querybook.oracles import ORACLES

    names = pipeline.run_pipeline(spark, inputs, str(tmp_path), day=date(2026, 10, 9))
    assert names == EVERYTHING
    checks = {
        "rejets_products": "rejected_products",
        "rejets_merchants": "rejected_merchants",
        "transactions_enrichies": "enriched_transactions",
        "transactions_suspectes": "suspicious_transactions",
        "kpi_marchands": "merchant_kpis",
        "top10_produits": "top10_products",
        "ca_categorie_region": "revenue_by_category_region",
        "ca_paiement_periode": "revenue_by_payment_period",
        "rejets_transactions": "rejected_transactions",
    }
    with oracle_connection(FOLDER) as connection:
        for output, query in checks.items():
            written = spark.read.parquet(f"{tmp_path}/parquet/{output}")
            columns, wanted = oracle_rows(connection, ORACLES[query])
            assert sorted(map(tuple, written.select(*columns).collect()), key=str) == sorted(wanted.elements(), key=str)
        written = spark.read.csv(f"{tmp_path}/rapport_qualite_20261009", header=True)
        columns, wanted = oracle_rows(connection, ORACLES["quality_report"])
        as_text = Counter(tuple(map(str, row)) for row in wanted.elements())
        assert Counter(map(tuple, written.select(*columns).collect())) == as_text
    for output in EVERYTHING[1:]:
        parquet = spark.read.parquet(f"{tmp_path}/parquet/{output}")
        flat = flatten_arrays(parquet)
        csv = spark.read.schema(flat.schema).csv(f"{tmp_path}/csv/{output}", header=True, enforceSchema=False)
        assert not empty_as_null(csv).exceptAll(empty_as_null(flat)).count() and csv.count() == flat.count()


def empty_as_null(df):
    return df.select(*(F.when(F.col(f.name).cast("string") != "", F.col(f.name)).alias(f.name) for f in df.schema))


@pytest.mark.parametrize("output", pipeline.ORDER)
def test_outputs_are_in_order(spark, output):
    """Rows of the files, one file after the other, follow the sort keys."""
    keys = [(key.removeprefix("-"), key.startswith("-")) for key in pipeline.ORDER[output]]
    columns = [key for key, _ in keys]
    rows = [tuple(rng) for rng in zip(*([3, 1, 2, 2, 1] for _ in columns), strict=True)]
    folder = new_path(spark, "ordered")
    df = spark.createDataFrame(rows * 40, ", ".join(f"`{c}` long" for c in columns)).repartition(7)
    order = [F.desc(c) if falls else F.asc(c) for c, falls in keys]
    pipeline.write_csv_and_parquet(df, folder, output, order, single_file=output in pipeline.SINGLE_FILE)
    for path in (f"{folder}/parquet/{output}", f"{folder}/csv/{output}"):
        files = sorted(Path(path).glob("part-*"))
        read = spark.read.parquet if "parquet" in path else partial(spark.read.csv, header=True)
        found = [tuple(map(int, r)) for f in files for r in read(str(f)).select(*columns).collect()]
        assert found == sorted(found, key=lambda r: [-v if falls else v for v, (_, falls) in zip(r, keys, strict=True)])


def tables_left(spark) -> set:
    return set(Path(shared_folder(spark)).glob("basketflow/run-*"))


def test_tables_of_a_run_are_released(spark, inputs, tmp_path):
    before = tables_left(spark)
    pipeline.run_pipeline(spark, inputs, str(tmp_path / "a"), "ingestion")
    with pytest.raises(RuntimeError), pytest.MonkeyPatch.context() as patch:
        patch.setattr(pipeline, "write_outputs", failing)
        pipeline.run_pipeline(spark, inputs, str(tmp_path / "b"), "transformation")
    assert tables_left(spark) == before
    pipeline.run_pipeline(spark, inputs, str(tmp_path / "c"), "ingestion", keep_tables=True)
    assert len(tables_left(spark) - before) == 1


def failing(*_):
    raise RuntimeError("no space")


def test_thresholds_from_the_command_line(spark, inputs, tmp_path, monkeypatch):
    seen = {}
    monkeypatch.setattr(pipeline, "run_pipeline", lambda *_, **options: seen.update(options))
    monkeypatch.setattr(type(spark), "stop", lambda _: None)
    pipeline.main(["all", "--input", "i", "--output", "o", "--min-age", "18", "--max-commission", "0.4", "--window-days", "3"])
    assert seen["limits"] == Limits(min_age=18, max_commission=0.4) and seen["scoring"] == Scoring(window_days=3)
    pipeline.main(["all", "--input", "i", "--output", "o"])
    assert seen["limits"] == Limits() and seen["scoring"] == Scoring()


@pytest.mark.parametrize(("master", "allowed"), [("local", True), ("local[4]", True), ("local-cluster[2,1,512]", False), ("spark://h:1", False)])
def test_only_one_process_may_use_a_machine_folder(monkeypatch, tmp_path, master, allowed):
    class Context:
        folder = None

        def getCheckpointDir(self):  # noqa: N802
            return self.folder

        def setCheckpointDir(self, folder):  # noqa: N802
            self.folder = folder

    session = SimpleNamespace(conf={}, sparkContext=Context())
    session.sparkContext.master = master
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    if allowed:
        assert shared_folder(session)
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session)


@pytest.mark.parametrize("mode", Reuse.MODES)
def test_reuse_modes_agree(spark, inputs, mode):
    raw = pipeline.read_inputs(spark, inputs)
    with Reuse(mode) as reuse:
        outputs = pipeline.build_outputs(raw, "transformation", reuse=reuse)
        assert outputs["transactions_suspectes"].count() > 0
        enriched = outputs["transactions_enrichies"]
        assert enriched.count() == 1000 - outputs["rejets_transactions"].count()
    assert not any(rdd for rdd in reuse._persisted)


def test_unknown_step(spark, inputs, capsys):
    with pytest.raises(ValueError, match="unknown step"):
        pipeline.build_outputs({}, "everything")
    pipeline.main(["everything", "--input", "in", "--output", "out"])
    assert "ingestion | transformation | analytics | all" in capsys.readouterr().out


def test_unknown_reuse_mode():
    with pytest.raises(ValueError, match="reuse must be"):
        Reuse("memory")


def test_intermediate_tables_go_to_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    table = as_table(spark.range(10), "ten")
    assert table.count() == 10
    assert all(file.startswith(f"file://{folder}") or file.startswith(f"file:{folder}") for file in table.inputFiles())


def test_known_sizes_spare_the_count(spark, inputs):
    """Dimensions that were counted when they were written are broadcast, or not, without a job."""
    raw = {name: as_table(df, name) for name, df in pipeline.read_inputs(spark, inputs).items()}
    asked = []
    counted = pipeline.wide_transactions

    def wide(**arguments):
        asked.append(arguments["rows"])
        return counted(**arguments)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pipeline, "wide_transactions", wide)
        pipeline.build_outputs(raw, "transformation", reuse=Reuse("table"))
        pipeline.build_outputs(raw, "transformation")
    valid = {name: valid_rows(df, name).count() for name, df in raw.items()}
    assert asked == [valid, {}]


def test_lines_of_unreadable_rows_on_request(spark, inputs, tmp_path):
    folder = tmp_path / "bad.csv"
    folder.mkdir()
    header = ",".join(pipeline.read_inputs(spark, inputs)["transactions"].columns)
    bad = "T1,U1,P1,M1,abc,20240101120000,Paris,CARD,Books"
    (folder / "part.csv").write_text(f"{header}\n{bad}\nT2,U1,P1,M1,2.5,20240101120000,Paris,CARD,Books\n")
    paths = replace(inputs, transactions=str(folder))
    out = str(tmp_path / "out")
    pipeline.run_pipeline(spark, paths, out, "transformation", keep_lines=True, day=date(2026, 1, 1))
    rejected = spark.read.parquet(f"{out}/parquet/rejets_transactions")
    assert [(r.transaction_id, r[pipeline.LINE]) for r in rejected.collect()] == [("T1", bad)]
    assert pipeline.LINE not in spark.read.parquet(f"{out}/parquet/transactions_enrichies").columns
    report = spark.read.csv(f"{out}/rapport_qualite_20260101", header=True).where("dataset = 'transactions'").first()
    assert (report.nb_lignes_lues, report.nb_lignes_valides, report.nb_valeurs_nulles) == ("2", "1", "1")
    plain = str(tmp_path / "plain")
    pipeline.run_pipeline(spark, paths, plain, "ingestion", day=date(2026, 1, 1))
    assert pipeline.LINE not in spark.read.parquet(f"{plain}/parquet/rejets_transactions").columns

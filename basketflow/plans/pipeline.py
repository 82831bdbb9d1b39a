"""The whole run: read, validate, report, enrich, analyse, write."""

import argparse
from collections.abc import Sequence
from dataclasses import fields, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.operators import cohorts, merchants, products, revenue
from basketflow.operators.quality import count_columns, quality_report
from basketflow.operators.suspicion import suspicious_transactions
from basketflow.operators.validation import rejected_rows, valid_rows
from basketflow.plans.enrichment import enriched, wide_transactions
from basketflow.plans.reuse import Reuse
from basketflow.settings import InputPaths, Limits, Scoring
from basketflow.shared import run_folder
from basketflow.sinks.writers import write_csv_and_parquet, write_dated_report
from basketflow.sources import readers

# Step names (each includes the steps before it) and output names.
STEPS = ("ingestion", "transformation", "analytics", "all")
QUALITY_REPORT = "rapport_qualite"
# Column of rejects, on request: the text of a row of which a cell does not fit its type.
LINE = "ligne_illisible"

# Sort keys of the outputs that have an order; a minus means falling.
ORDER = {
    "transactions_suspectes": ["-amount", "transaction_id"],
    "kpi_marchands": ["merchant_id"],
    "cohortes_retention": ["cohort_month", "period_index"],
    "top10_produits": ["rang"],
    "ca_categorie_region": ["region", "category"],
    "ca_paiement_periode": ["payment_method", "day_period"],
}
# Reports whose size does not follow the number of transactions; the other CSV outputs keep their partitions.
SINGLE_FILE = {
    "cohortes_retention",
    "meilleure_cohorte_3m",
    "top10_produits",
    "ca_categorie_region",
    "ca_paiement_periode",
}


def read_inputs(spark: SparkSession, paths: InputPaths, keep_lines: bool = False) -> dict[str, DataFrame]:
    """The four tables. With ``keep_lines`` those from text files say in a last column what an unreadable row was."""
    line = LINE if keep_lines else None
    return {
        "transactions": readers.read_transactions(spark, paths.transactions, line),
        "users": readers.read_users(spark, paths.users, line),
        "products": readers.read_products(spark, paths.products),
        "merchants": readers.read_merchants(spark, paths.merchants, line),
    }


def build_outputs(
    raw: dict[str, DataFrame],
    upto: str = "all",
    limits: Limits = Limits(),
    scoring: Scoring = Scoring(),
    reuse: Reuse | None = None,
    broadcast: bool = False,
) -> dict[str, DataFrame]:
    """Output name -> DataFrame for the steps up to ``upto``. ``raw`` has the four tables by name."""
    if upto not in STEPS:
        raise ValueError(f"unknown step {upto!r}; one of {', '.join(STEPS)}")
    kept = reuse or Reuse("none")
    keep = kept.keep

    # every raw table is read by the report, its rejects and its valid half: parse text formats once, count on the way
    counted = {
        name: kept.keep_counted(df, f"raw_{name}", count_columns([c for c in df.columns if c != LINE], name, limits))
        for name, df in raw.items()
    }
    raw = {name: df for name, (df, _) in counted.items()}
    known = {name: counts for name, (_, counts) in counted.items() if counts is not None}
    outputs = {QUALITY_REPORT: quality_report(**{name: df.drop(LINE) for name, df in raw.items()}, limits=limits, known=known)}
    outputs |= {f"rejets_{name}": rejected_rows(df, name, limits) for name, df in raw.items()}
    if upto == "ingestion":
        return outputs

    valid = {name: valid_rows(df, name, limits).drop(LINE) for name, df in raw.items()}
    rows = {name: counts["nb_lignes_valides"] for name, counts in known.items()}
    wide = keep(wide_transactions(**valid, scoring=scoring, broadcast=broadcast, rows=rows), "wide_transactions")
    outputs["transactions_enrichies"] = enriched(wide)
    outputs["transactions_suspectes"] = suspicious_transactions(wide)
    if upto == "transformation":
        return outputs

    retention = keep(cohorts.cohort_retention(wide), "cohort_retention")
    return outputs | {
        "kpi_marchands": merchants.merchant_kpis(wide),
        "cohortes_retention": retention,
        "meilleure_cohorte_3m": cohorts.best_cohort(retention),
        "top10_produits": products.top_products(wide),
        "ca_categorie_region": revenue.by_category_and_region(wide),
        "ca_paiement_periode": revenue.by_payment_and_period(wide),
    }


def write_outputs(outputs: dict[str, DataFrame], folder: str, day: date) -> None:
    for name, df in outputs.items():
        if name == QUALITY_REPORT:
            write_dated_report(df, folder, name, day)
            continue
        order = [F.desc(key[1:]) if key.startswith("-") else F.asc(key) for key in ORDER.get(name, [])]
        write_csv_and_parquet(df, folder, name, order, single_file=name in SINGLE_FILE)


def run_pipeline(
    spark: SparkSession,
    paths: InputPaths,
    output: str,
    upto: str = "all",
    limits: Limits = Limits(),
    scoring: Scoring = Scoring(),
    reuse: str = "table",
    broadcast: bool = False,
    day: date | None = None,
    keep_tables: bool = False,
    keep_lines: bool = False,
) -> list[str]:
    """Read the inputs, write every output of the steps up to ``upto`` and return their names.

    With ``keep_lines`` rejects also hold the text of rows that could not be read. Intermediate tables are deleted at the end, also of a failed run, unless ``keep_tables``.
    """
    with run_folder(spark, keep=keep_tables), Reuse(reuse) as kept:
        outputs = build_outputs(read_inputs(spark, paths, keep_lines), upto, limits, scoring, kept, broadcast)
        write_outputs(outputs, output, day or date.today())
    return list(outputs)


def _settings(kind: type, chosen: argparse.Namespace):
    """``Limits`` or ``Scoring`` from the command line, which has an option for each of their fields."""
    return kind(**{option.name: getattr(chosen, option.name) for option in fields(kind)})


def main(arguments: Sequence[str] | None = None) -> None:
    """For spark-submit; master, memory and partitions come from there."""
    parser = argparse.ArgumentParser(prog="basketflow", description=__doc__)
    parser.add_argument("step", nargs="?", default="all", help=" | ".join(STEPS))
    parser.add_argument("--input", required=True, help="folder with the four input tables")
    for table in fields(InputPaths):
        parser.add_argument(f"--{table.name}", help="path of this table, if not under --input")
    parser.add_argument("--output", required=True, help="folder for the results")
    parser.add_argument("--reuse", choices=Reuse.MODES, default="table")
    parser.add_argument("--broadcast", action="store_true", help="broadcast users too, if counted to be few")
    parser.add_argument("--keep-tables", action="store_true", help="leave intermediate tables in the shared folder")
    parser.add_argument("--keep-lines", action="store_true", help="rejects also hold the text of unreadable rows")
    for settings in (Limits, Scoring):
        for option in fields(settings):
            name = f"--{option.name.replace('_', '-')}"
            parser.add_argument(name, type=type(option.default), default=option.default, help="default %(default)s")
    chosen = parser.parse_args(arguments)
    step = chosen.step.strip().lower()
    if step not in STEPS:
        parser.print_help()
        return
    elsewhere = {t.name: getattr(chosen, t.name) for t in fields(InputPaths) if getattr(chosen, t.name)}
    paths = replace(InputPaths.under(chosen.input), **elsewhere)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        run_pipeline(
            spark,
            paths,
            chosen.output,
            step,
            limits=_settings(Limits, chosen),
            scoring=_settings(Scoring, chosen),
            reuse=chosen.reuse,
            broadcast=chosen.broadcast,
            keep_tables=chosen.keep_tables,
            keep_lines=chosen.keep_lines,
        )
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

"""Jobs for spark-submit.

    spark-submit -m orderrisk reshape  --cards CSV --orders CSV
    spark-submit -m orderrisk build    --orders CSV --mart PATH
    spark-submit -m orderrisk train    --mart PATH --out PATH [--iters N]
    spark-submit -m orderrisk predict  --mart PATH --out PATH
    spark-submit -m orderrisk compare  --mart PATH --out PATH [--iters N]
    spark-submit -m orderrisk explain  --mart PATH --out PATH
    spark-submit -m orderrisk report   --mart PATH --out PATH [--tier T] [--payment P] [--category C]
    spark-submit -m orderrisk stress   --orders CSV --out PATH
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from orderrisk.operators import models
from orderrisk.plans import build, modelling, reporting
from orderrisk.sources import files


def _write_all(tables: dict, out: str) -> None:
    for name, df in tables.items():
        if name == "flagged_export":
            files.write_csv(df, f"{out}/{name}", quote_all=True)
        else:
            files.write_table(df, f"{out}/{name}")


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="orderrisk")
    parser.add_argument(
        "job", choices=["reshape", "build", "train", "predict", "compare", "explain", "report", "stress"]
    )
    for name in ("cards", "orders", "mart", "out", "tier", "payment", "category"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--iters", type=int, default=200)
    args = parser.parse_args(arguments)
    spark = spark or SparkSession.builder.appName(f"orderrisk-{args.job}").getOrCreate()

    if args.job == "reshape":
        build.reshape_cards(spark, args.cards, args.orders).show(50, truncate=False)
    elif args.job == "build":
        build.build_mart(files.read_orders(spark, args.orders), args.mart)
    elif args.job == "stress":
        _write_all(build.stress(files.read_orders(spark, args.orders, labelled=False)), args.out)
    else:
        mart = files.read_table(spark, args.mart)
        if args.job == "train":
            modelling.train(mart, args.out, args.iters)
        elif args.job == "predict":
            modelling.predict(mart, args.out)
        elif args.job == "compare":
            _write_all(modelling.compare(mart, args.out, args.iters), args.out)
        elif args.job == "explain":
            _, test_rows = modelling.split_rows(mart, f"{args.out}/model_rows")
            explained = modelling.explain_model(models.load_model(f"{args.out}/model"), test_rows, args.out)
            _write_all({k: v for k, v in explained.items() if k != "tree_shap"}, args.out)
        else:
            preds = metrics = None
            if files.exists(spark, f"{args.out}/ml_predictions"):
                preds = files.read_table(spark, f"{args.out}/ml_predictions")
            if files.exists(spark, f"{args.out}/ml_metrics"):
                metrics = files.read_table(spark, f"{args.out}/ml_metrics")
            chosen = {name: getattr(args, name) for name in ("tier", "payment", "category")}
            _write_all(reporting.report_tables(mart, preds, metrics, **chosen), f"{args.out}/report")
            _write_all(reporting.exploration_tables(mart), f"{args.out}/exploration")
            _write_all(reporting.baseline_tables(mart), f"{args.out}/baseline")


if __name__ == "__main__":
    main()

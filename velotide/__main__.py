"""Command line: ``python -m velotide JOB --option value ...``.

On a cluster: ``spark-submit --py-files velotide.zip velotide/__main__.py JOB ...``.
"""

from __future__ import annotations

import argparse

from velotide.operators import reports
from velotide.plans import bronze, gold, prices, scoring, serving, silver, training
from velotide.schemas import FORECAST_REQUEST, PRICE_REQUEST, PRICING
from velotide.session import build_session
from velotide.sources.demand_index import read_demand_index, write_demand_index
from velotide.sources.parquet import read_parquet, read_parquet_or_empty, write_parquet
from velotide.sources.trips import land_trip_files, land_with_quarantine

REPORTS = {
    "zone-summary": reports.zone_summary,
    "zone-counts": reports.zone_counts,
    "hourly-profile": reports.hourly_profile,
    "price-histogram": reports.price_histogram,
    "station-stats": reports.station_stats,
    "hotspots": reports.hotspots,
    "top-surge-stations": reports.top_surge_stations,
    "headline-figures": reports.headline_figures,
    "demand-scatter": reports.demand_scatter,
}


def _ingest(spark, o):
    if o.quarantine:
        counts = land_with_quarantine(spark, o.csv, o.out, o.quarantine)
        print(f"rows read: {counts.read}, landed: {counts.landed}, quarantined: {counts.quarantined}")
    else:
        print(f"rows read: {land_trip_files(spark, o.csv, o.out)}")


def _bronze(spark, o):
    bronze.run_bronze(spark, o.raw, o.trips, o.stations).show()


def _silver(spark, o):
    silver.run_silver(spark, o.trips, o.stations, o.feed, o.out, o.weather, o.radius)


def _gold(spark, o):
    categories = o.categories.split(",") if o.categories else None
    gold.run_gold(spark, o.silver, o.out, o.model, o.k, categories, o.min_rows)


def _components(spark, o):
    gold.component_report(read_parquet(spark, o.silver), o.k, o.model).show()


def _prices(spark, o):
    prices.pricing_summary(prices.run_pricing(spark, o.silver, o.csv, o.out)).show()


def _report(spark, o):
    table = REPORTS[o.name](_priced(spark, o))
    if o.out:
        write_parquet(table, o.out)
    else:
        table.show(100, truncate=False)


def _priced(spark, o):
    """The priced history; before the first pricing run there is none."""
    return read_parquet_or_empty(spark, o.prices, PRICING)


def _history(spark, o):
    """A stored index if one is named, else the priced history itself."""
    if not (o.index or o.prices):
        raise SystemExit("one of --prices and --index is needed")
    return read_demand_index(spark, o.index) if o.index else _priced(spark, o)


def _index(spark, o):
    index = write_demand_index(_priced(spark, o), o.out, o.buckets)
    print(f"station-hours: {index.by_station.count()}, hours of day: {index.by_hour.count()}")


def _answer(spark, o):
    requests = spark.read.schema(PRICE_REQUEST).option("header", True).csv(o.requests)
    write_parquet(serving.answer_requests(requests, _history(spark, o)), o.out)


def _forecast(spark, o):
    requests = spark.read.schema(FORECAST_REQUEST).option("header", True).csv(o.requests)
    write_parquet(serving.forecast(requests, _history(spark, o), o.as_of), o.out)


def _parts(text, names):
    """Shares of the parts as ``0.8,0.1,0.1``."""
    shares = [float(x) for x in text.split(",")]
    if len(shares) != len(names):
        raise SystemExit(f"shares of {', '.join(names)} are needed: {text}")
    return dict(zip(names, shares, strict=True))


def _train(spark, o):
    parts = _parts(o.parts, training.TRAINING_PARTS)
    params = {"seed": o.seed}
    summary, _ = training.train(read_parquet(spark, o.silver), o.kind, o.features, o.model, o.summary, parts, **params)
    summary.show(truncate=False)


def _search(spark, o):
    table = training.search(
        read_parquet(spark, o.silver), o.kind, o.target, o.trials, out=o.out, seed=o.seed, parallelism=o.parallel,
        max_fit_rows=o.rows, method=o.method, parts=_parts(o.parts, training.SEARCH_PARTS), summary_path=o.summary,
    )
    table.orderBy("rmse").show(truncate=False)


def _score(spark, o):
    if o.checkpoint:
        query = scoring.score_stream(spark, o.silver, o.model, o.out, o.checkpoint)
        query.awaitTermination()
        print(f"rows scored: {sum(p['numInputRows'] for p in query.recentProgress)}")
    else:
        scoring.score_table(spark, o.silver, o.model, o.out).show()


# job -> (function, required options, optional ones with their defaults; a type has none)
JOBS = {
    "ingest": (_ingest, ["csv", "out"], {"quarantine": None}),
    "bronze": (_bronze, ["raw", "trips", "stations"], {}),
    "silver": (_silver, ["trips", "stations", "feed", "out"], {"weather": None, "radius": 100.0}),
    "gold": (_gold, ["silver", "out", "model"], {"k": 8, "categories": None, "min-rows": 1}),
    "components": (_components, ["silver"], {"k": 5, "model": None}),
    "prices": (_prices, ["silver", "csv"], {"out": None}),
    "report": (_report, ["name", "prices"], {"out": None}),
    "index": (_index, ["prices", "out"], {"buckets": int}),
    "answer": (_answer, ["requests", "out"], {"prices": None, "index": None}),
    "forecast": (_forecast, ["requests", "as-of", "out"], {"prices": None, "index": None}),
    "train": (
        _train,
        ["silver"],
        {"kind": "rf", "features": "all", "model": None, "summary": None, "parts": "0.8,0.1,0.1", "seed": 42},
    ),
    "search": (
        _search,
        ["silver"],
        {"kind": "rf", "target": "bike", "trials": 20, "out": None, "method": "random", "parts": "0.8,0.2",
         "seed": 42, "rows": int, "parallel": int, "summary": None},
    ),
    "score": (_score, ["silver", "model", "out"], {"checkpoint": None}),
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="velotide", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, (_, required, optional) in JOBS.items():
        job = jobs.add_parser(name)
        for option in required:
            job.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            if isinstance(default, type):
                job.add_argument(f"--{option}", type=default)
            else:
                job.add_argument(f"--{option}", default=default, type=str if default is None else type(default))
    options = parser.parse_args(argv)
    spark = build_session(f"velotide-{options.job}")
    JOBS[options.job][0](spark, options)


if __name__ == "__main__":
    main()

"""Command line: the verbs that make sense without a network, over stored tables."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from . import queries, sinks
from .operators import extract, joins, quality, runs, stages
from .plans import run as report_run
from .streaming import archive, now, versions

#: Verbs that read a table and write its next version, with what else each one reads.
VERBS = {
    "normalize": ("canonical factions and ministries, and flags", ["ministries", "aliases", "overrides"]),
    "merge": ("what documents and table say of each other", ["letters", "texts"]),
    "resolve": ("explain flags automatically", ["letters", "texts"]),
    "build-abgeordnete-index": ("the lexicon of members", []),
    "extract-all-anfrager": ("all members that texts name", ["texts", "lexicon"]),
    "review": ("notes and verdicts of a table of decisions", ["decisions"]),
    "search-again": ("new search hits of some questions", ["hits", "numbers"]),
    "extract-datum-original": ("dates of letters from first pages", ["pages", "existing"]),
    "fix-anfrager-mismatches": ("a second try at askers of logged rows", ["lines", "texts", "lexicon"]),
    "extract-multi-ministerium": ("all ministries that texts name", ["texts", "ministries", "aliases"]),
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="inquirylake")
    verbs = out.add_subparsers(dest="verb", required=True)
    run = verbs.add_parser("run", help="run registered queries over a folder of tables")
    run.add_argument("folder")
    run.add_argument("names", nargs="+")
    run.add_argument("--out", help="write results below this folder instead of showing them")
    report = verbs.add_parser("report", help="all reports over a folder of tables, from one scan")
    report.add_argument("folder")
    report.add_argument("--out", required=True)
    triage = verbs.add_parser("build-ministerien-erkennung", help="the triage table of a log of unknown ministries")
    triage.add_argument("lines", help="a table of value and position")
    triage.add_argument("--ministries", required=True)
    triage.add_argument("--table", help="the table that gives terms and question numbers")
    triage.add_argument("--out", required=True)
    scan = verbs.add_parser("scan-archive", help="new document texts below a folder, decided on, parsed and merged into a table")
    scan.add_argument("folder")
    scan.add_argument("--table", required=True, help="folder of versions")
    scan.add_argument("--checkpoint", required=True, help="folder of the mark from which the next run goes on, and of the audit")
    scan.add_argument("--wahlperiode", type=int)
    scan.add_argument("--batch", type=int, default=1000, help="documents a batch, in the order of their time")
    scan.add_argument("--allow-discovery", action="store_true", help="add rows for papers that the table lacks")
    scan.add_argument("--force", action="store_true", help="parse complete and withdrawn rows again")
    verify = verbs.add_parser("verify", help="check a table; exit code 1 on findings")
    verify.add_argument("table")
    verify.add_argument("--texts", help="table of key and text")
    verify.add_argument("--key", default="drucksache_antwort_nr")
    for verb, (text, inputs) in VERBS.items():
        one = verbs.add_parser(verb, help=text)
        one.add_argument("table")
        one.add_argument("--out", required=True, help="folder of versions")
        one.add_argument("--key", default="drucksache_antwort_nr")
        one.add_argument("--wahlperiode", type=int)
        one.add_argument("--dry-run", action="store_true", help="show counters, write nothing")
        for name in inputs:
            one.add_argument(f"--{name}", required=True, help="a parquet table")
    return out


def _change(verb: str, rows: DataFrame, more: dict[str, DataFrame], key: str) -> DataFrame:
    if verb == "normalize":
        names = more["ministries"]
        return quality.normalise(rows, names.select("code", "name", "position"), more["aliases"], more["overrides"])
    if verb == "merge":
        return stages.merge(rows, more["letters"], more["texts"], key)
    if verb == "resolve":
        return stages.resolve_auto(rows, more["letters"], more["texts"], key)
    if verb == "build-abgeordnete-index":
        listed = [c for c in ("anfrager", "anfrager_alle") if c in rows.columns]
        return extract.lexicon(rows.where("wp is not null and fraktion <> ''"), ["wp", "fraktion"], listed)
    if verb == "extract-all-anfrager":
        return stages.extract_members(rows, more["texts"], more["lexicon"], key)
    if verb == "review":
        return runs.reviewed(rows, more["decisions"], now(), key)
    if verb == "search-again":
        return runs.searched_again(rows, more["hits"], more["numbers"], now())
    if verb == "extract-datum-original":
        return runs.letters(rows.withColumnsRenamed(runs.NAMES), more["pages"], more["existing"])
    if verb == "fix-anfrager-mismatches":
        return runs.tried_again(rows, more["lines"], more["texts"], more["lexicon"], key)
    return stages.involve_ministries(rows, more["texts"], more["ministries"].select("code", "name", "position"), more["aliases"], key)


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("inquirylake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.verb == "run":
        for name in args.names:
            result = queries.QUERIES[name](spark, args.folder)
            sinks.save_report(result, f"{args.out}/{name}") if args.out else result.show(50, truncate=80)
        return 0
    if args.verb == "report":
        report_run.write(queries.reports.facts(spark, args.folder), args.out)
        return 0
    if args.verb == "build-ministerien-erkennung":
        rows = versions.load(spark, args.table) if args.table else None
        sinks.save_report(runs.triage(versions.load(spark, args.lines), versions.load(spark, args.ministries), rows), args.out)
        return 0
    if args.verb == "scan-archive":
        texts = archive.documents(spark, args.folder, args.wahlperiode, args.batch)
        archive.scan(texts, args.table, f"{args.checkpoint}/mark", f"{args.checkpoint}/audit", args.allow_discovery, args.force).awaitTermination()
        stages.counters(archive.decisions(spark, f"{args.checkpoint}/audit"), "action").orderBy("action").show()
        return 0
    rows = versions.load(spark, args.table)
    if args.verb == "verify":
        texts = spark.read.parquet(args.texts) if args.texts else spark.createDataFrame([], f"{args.key} string, text string")
        findings = quality.verify(rows if args.texts else rows.withColumn("antworttext_status", rows["antworttext_status"].substr(1, 0)), texts, args.key)
        summary = quality.report(findings, args.key)
        summary.show(truncate=120)
        return quality.exit_code(summary, quality.FAILING, rows.count())
    more = {name: versions.load(spark, getattr(args, name)) for name in VERBS[args.verb][1]}
    chosen = rows if args.wahlperiode is None else rows.where(rows["wp"] == args.wahlperiode)
    changed = _change(args.verb, chosen, more, args.key)
    if args.verb not in ("build-abgeordnete-index", "extract-datum-original") and args.wahlperiode is not None:
        changed = changed.unionByName(joins.orphans(rows, chosen, args.key), allowMissingColumns=True)
    counted, counts = stages.observed(changed, next((c for c in ("disposition", "datenqualitaet") if c in changed.columns), None))
    if args.dry_run:
        counted.write.format("noop").mode("overwrite").save()
    else:
        versions.replace(counted.drop("disposition", "outcome_anfragedatum", "outcome_antwortdatum"), args.out, next(c for c in (args.key, "paper", "form") if c in changed.columns))
    print(" ".join(f"{name}={n}" for name, n in counts.get.items() if n or name == "rows"))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

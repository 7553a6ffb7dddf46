"""Command line: download, journals, load, update, export, validate, status, sql.

Exit codes: 0 done, 1 failed, 2 warnings with ``--fail-on-warn``.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys
from pathlib import Path

from pyspark.sql import functions as F

from . import loading, session
from .files import Files
from .sinks import exports
from .sources import download as dl
from .sources import live
from .status import readiness, summarize
from .store import Store, local_files, merge_download
from .validate import run_validation
from .validate.report import format_summary, write_report


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="citelake", description=__doc__)
    p.add_argument("--data-dir", default=os.environ.get("CITELAKE_DATA_DIR", "data"))
    p.add_argument("--store", default=os.environ.get("CITELAKE_STORE"), help="folder of the tables; <data-dir>/store by default")
    p.add_argument("--master", default=os.environ.get("CITELAKE_MASTER"))
    p.add_argument("--threads", type=int, help="cores of a local session")
    p.add_argument("--temp-dir", help="folder for spilled data of a local session")
    p.add_argument("--memory-limit", help="memory of the driver, as 48g; it is the whole of a local session")
    p.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE", help="Spark setting")
    p.add_argument("-v", "--verbose", action="store_true")
    sub = p.add_subparsers(dest="command", required=True)
    positive = lambda s: int(s) if int(s) >= 1 else (_ for _ in ()).throw(argparse.ArgumentTypeError("must be at least 1"))
    get = argparse.ArgumentParser(add_help=False)
    for flag in ("baseline", "updates", "verify"):
        get.add_argument(f"--{flag}", action=argparse.BooleanOptionalAction, default=True)
    get.add_argument("--limit", type=positive, help="newest files of each kind")
    get.add_argument("--mirror", help="local folder with baseline/ and updatefiles/ to copy from instead of the web")
    sub.add_parser("download", parents=[get])
    sub.add_parser("journals").add_argument("--overview", help="journal overview text; <data-dir>/J_Entrez.txt by default")
    sub.add_parser("load").add_argument("--force", action="store_true")
    up = sub.add_parser("update", parents=[get])
    up.add_argument("--force", action="store_true")
    up.add_argument("--overview")
    e = sub.add_parser("export")
    e.add_argument("--format", choices=("json", "parquet"), required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--shards", type=positive)
    e.add_argument("--gzip", action=argparse.BooleanOptionalAction, default=None)
    e.add_argument("--latest", action=argparse.BooleanOptionalAction, default=None)
    v = sub.add_parser("validate")
    v.add_argument("dir")
    for f in ("previous-report", "previous-manifest", "manifest", "out"):
        v.add_argument(f"--{f}")
    for f, d in (("sample-size", 15), ("drop-sample", 10), ("seed", 0)):
        v.add_argument(f"--{f}", type=int, default=d)
    for f, d in (("abstract-threshold", 0.90), ("entrez-low", 0.95), ("entrez-high", 1.05)):
        v.add_argument(f"--{f}", type=float, default=d)
    v.add_argument("--fail-on-warn", action="store_true")
    v.add_argument("--online", action=argparse.BooleanOptionalAction, default=True, help="compare with the live service")
    v.add_argument("--offline", dest="online", action="store_false")
    v.add_argument("--api-key", default=os.environ.get("NCBI_API_KEY"))
    v.add_argument("--email", default=os.environ.get("NCBI_EMAIL"))
    sub.add_parser("status")
    sub.add_parser("sql", help="ask the tables, and latest_article, in SQL").add_argument("query")
    return p


def _say(*x) -> None:
    print(*x, flush=True)


def _load(store: Store, data_dir: str, force: bool) -> int:
    files = local_files(store, data_dir)
    if not files:
        _say(f"no release files in {data_dir}")
        return 1
    n, failed = loading.load_files(store, files, force)
    _say(f"loaded {n} file(s)" + (f", failed: {', '.join(failed)}" if failed else ""))
    return int(bool(failed))


def _journals(store: Store, path: str) -> int:
    n = loading.load_journals(store, path)
    _say(f"{n} journal(s)")
    return int(not n)


def _download(store: Store, a: argparse.Namespace) -> int:
    """Bring the local copy up to date, from the web or a mirror folder."""
    registry = {r["file_name"]: r["published_md5"] for r in store.registry().select("file_name", "published_md5").collect()}
    done: list[dl.Synced] = []
    for kind, wanted in (("baseline", a.baseline), ("update", a.updates)):
        folder = dl.FOLDERS[kind]
        source = dl.Mirror(Path(a.mirror) / folder) if a.mirror else dl.Web(dl.SOURCES[kind])
        if wanted:
            done += dl.sync_kind(source.listing(), kind, Path(a.data_dir) / folder, registry, source.sidecar, source.fetch, a.limit, a.verify)
    if done:
        names = "file_name string, kind string, published_md5 string, changed boolean"
        rows = store.spark.createDataFrame([(d.file_name, d.kind, d.published_md5, d.changed) for d in done], names).withColumn("at", F.current_timestamp())
        store.merge_registry(lambda registry: merge_download(registry, rows))
    _say(f"{len(done)} file(s), {sum(d.changed for d in done)} new or changed")
    return 0


def _refresh(store: Store, a: argparse.Namespace) -> int:
    """The journals of the given overview, else of the newest from the web, else of the local copy."""
    path = getattr(a, "overview", None)
    if not path:
        path = f"{a.data_dir}/J_Entrez.txt"
        if not Path(path).exists() or not getattr(a, "mirror", None):
            try:
                web = dl.Web(dl.OVERVIEW.rpartition("/")[0])
                Path(path).parent.mkdir(parents=True, exist_ok=True)
                web.fetch(dl.OVERVIEW.rpartition("/")[2], Path(path))
            except OSError as e:
                if not Path(path).exists():
                    raise
                _say(f"warning: the overview in {a.data_dir} is used: {e}")
    return _journals(store, path)


def _export(store: Store, a: argparse.Namespace) -> int:
    unused = {"json": [("latest", a.latest)], "parquet": [("shards", a.shards), ("gzip", a.gzip)]}[a.format]
    for flag, value in unused:
        if value is not None:
            _say(f"warning: --{flag} has no effect on {a.format}")
    error, warnings = readiness(store)
    for w in warnings:
        _say(f"warning: {w}")
    if error:
        _say(f"error: {error}")
        return 1
    t = store.tables()
    if a.format == "json":
        paths = exports.export_json(t, a.out, a.shards, a.gzip is not False)
    else:
        paths = exports.export_parquet(t, a.out, a.latest is not False)
    _say(f"wrote {len(paths)} file(s) to {a.out}")
    return 0


def _validate(store: Store, a: argparse.Namespace) -> int:
    t = store.tables()
    t = None if t["article"].isEmpty() else t
    get = live.Transport(a.api_key, a.email) if a.online else None
    if a.online and not a.email:
        _say("warning: the service asks callers to name themselves: --email or NCBI_EMAIL")
    report = run_validation(
        store.spark, a.dir, t, api_key_used=bool(a.api_key), total=get and (lambda: live.total(get)), fetch=get and (lambda pmids: live.documents(store.spark, get, pmids)),
        previous_report=a.previous_report, previous_manifest=a.previous_manifest, manifest_out=a.manifest, sample_size=a.sample_size,
        drop_sample=a.drop_sample, seed=a.seed, abstract_threshold=a.abstract_threshold, entrez_low=a.entrez_low, entrez_high=a.entrez_high,
    )
    out = a.out or f"{a.dir.rstrip('/')}/validation_report.json"
    write_report(Files(store.spark, out), report, out)
    _say(format_summary(report))
    _say(f"report in {out}")
    return 1 if report["status"] == "fail" else 2 if report["status"] == "warn" and a.fail_on_warn else 0


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO if a.verbose else logging.WARNING)
    conf = {k: v for k, _, v in (c.partition("=") for c in a.conf)}
    conf |= {k: v for k, v in (("spark.local.dir", a.temp_dir), ("spark.driver.memory", a.memory_limit)) if v}
    master = a.master or (f"local[{a.threads}]" if a.threads else None)
    spark = session.build(master, **{k.replace(".", "__"): v for k, v in conf.items()})  # before there is a JVM, so memory counts
    store = Store(spark, a.store or f"{a.data_dir}/store")
    if a.command == "download":
        return _download(store, a)
    if a.command == "journals":
        return _refresh(store, a)
    if a.command == "load":
        return _load(store, a.data_dir, a.force)
    if a.command == "update":
        code = _download(store, a)
        if code:
            return code
        try:
            _refresh(store, a)
        except Exception as e:  # noqa: BLE001 - old journals stay in use
            _say(f"warning: journals not refreshed: {str(e).splitlines()[0]}")
        return _load(store, a.data_dir, a.force)
    if a.command == "sql":
        store.views()
        spark.sql(a.query).show(1000, False)
        return 0
    if a.command == "export":
        return _export(store, a)
    if a.command == "validate":
        return _validate(store, a)
    _say(json.dumps(summarize(store), indent=2, default=lambda t: f"{t:%Y-%m-%d %H:%M}"))
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Command line."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from dataclasses import asdict
from datetime import UTC, date, datetime, timedelta

from fathomline.plans import census, incremental, layers, reconcile, replay, seed
from fathomline.plans.ledger import Ledger, pull, push
from fathomline.session import session
from fathomline.sources.archives import PLACE, Archive, Bucket, Folder
from fathomline.sources.readings import keyed


def moment(text: str) -> datetime:
    t = datetime.fromisoformat(text)
    return t if t.tzinfo else t.replace(tzinfo=UTC)


def archive(args: argparse.Namespace) -> Archive:
    if args.local:
        return Folder(args.local, args.place)
    if not args.fetched:
        raise SystemExit("--bucket needs --fetched, a folder that all executors share")
    return Bucket(args.bucket, args.fetched, args.place)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="fathomline", description="Census of published observation files.")
    top.add_argument("--master", default=None, help="Spark master, for example local[8]")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, about: str, *folders: str, listing: bool = False) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=about, description=about)
        for folder in folders:
            p.add_argument(f"--{folder}", required=True, help="path on any file system that Spark reaches")
        if listing:
            one = p.add_mutually_exclusive_group(required=True)
            one.add_argument("--local", help="folder laid out like the bucket, on any file system that Spark reaches")
            one.add_argument("--bucket", help="host of a public bucket that is reached by HTTP")
            p.add_argument("--fetched", help="shared folder for what was fetched from a bucket")
            p.add_argument("--place", default=PLACE, help="where the published files lie below the root")
        return p

    p = command("backfill", "Stage, rank and finalize days of published files.", "out", listing=True)
    p.add_argument("--start", type=date.fromisoformat, required=True)
    p.add_argument("--end", type=date.fromisoformat, required=True, help="last day")
    p = command("rank", "Rank staged readings, as of a moment if so wished.", "out")
    p.add_argument("--before", type=moment)
    p.add_argument("--dest")
    command("seed", "Seed a state from a census.", "backfill", "state", listing=True)
    p = command("incremental", "Classify what is new.", "state", listing=True)
    p.add_argument("--remote")
    p.add_argument("--max-files", type=int, default=incremental.MAX_FILES)
    p.add_argument("--max-bytes", type=int, default=incremental.MAX_BYTES)
    p.add_argument("--now", type=moment)
    command("reconcile", "Compare the whole listing with the index.", "state", listing=True).add_argument("--now", type=moment)
    p = command("underway-seed", "Minutes of all live tracks.", "state", "cache", listing=True)
    p.add_argument("--chunk-files", type=int, default=seed.CHUNK)
    p = command("replay", "Replay and compare with the census.", "backfill", "state", listing=True)
    for name in ("start", "end"):
        p.add_argument(f"--{name}", type=moment, required=True)
    p.add_argument("--resume-at", type=moment)
    p.add_argument("--step-hours", type=float, default=6)
    p.add_argument("--grace-hours", type=float, default=6)
    p.add_argument("--tolerance", type=float, default=1e-4)
    command("pull", "Bring the state to the remote's generation.", "state", "remote")
    command("push", "Mirror the state.", "state", "remote").add_argument("--init", action="store_true")
    p = command("layers", "Write the published files.", "state", "out")
    p.add_argument("--providers", action="store_true")
    p.add_argument("--now", type=moment)
    command("region", "Coverage of a polygon.", "state", "polygon", "out")
    command("extract", "Readings inside a polygon.", "backfill", "polygon", "out").add_argument("--res", type=int, default=10)
    return top


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    now = getattr(args, "now", None) or datetime.now(UTC)
    spark = session(args.master)
    show = lambda doc: print(json.dumps(doc, indent=2, default=str))
    ledger = Ledger(spark, args.state) if "state" in args else None
    if args.command == "backfill":
        held, day, done = archive(args), args.start, census.batches(spark, args.out)
        while day <= args.end:
            if str(day) not in done:
                census.stage(spark, keyed(held.published(spark, held.listing(spark, [day]))), args.out, str(day))
            day += timedelta(days=1)
    if args.command in ("backfill", "rank"):
        before, dest = getattr(args, "before", None), getattr(args, "dest", None)
        before = incremental.naive(before) if before else None
        census.rank(spark, args.out, before, dest)
        print(census.finalize(spark, args.out, before, dest))
    elif args.command == "seed":
        print(seed.seed(spark, args.backfill, ledger, archive(args)))
    elif args.command == "incremental":
        remote = Ledger(spark, args.remote) if args.remote else None
        if remote:
            pull(ledger, remote)
        result = incremental.run(spark, ledger, archive(args), now, f"run-{now:%Y%m%dT%H%M%S}", args.max_files, args.max_bytes)
        if remote and result.new_files:
            push(ledger, remote)
        show(asdict(result))
    elif args.command == "reconcile":
        show(asdict(reconcile.reconcile(spark, ledger, archive(args), now)))
    elif args.command == "underway-seed":
        show(seed.seed_underway(spark, ledger, args.cache, archive(args), args.chunk_files))
    elif args.command == "replay":
        report = replay.replay(spark, args.backfill, ledger, archive(args), args.start, args.end, args.step_hours, args.grace_hours, args.resume_at, args.tolerance)
        show(report)
        return int(not report["pass"])
    elif args.command == "pull":
        pull(ledger, Ledger(spark, args.remote))
    elif args.command == "push":
        push(ledger, Ledger(spark, args.remote), args.init)
    elif args.command == "layers":
        show(layers.build(spark, ledger, args.out, args.providers, now))
    elif args.command == "region":
        show(layers.build_region(spark, ledger, args.polygon, args.out))
    elif args.command == "extract":
        print(layers.extract_region(spark, census.staged(spark, args.backfill), args.polygon, args.out, args.res))
    return 0


if __name__ == "__main__":
    sys.exit(main())

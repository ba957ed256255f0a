"""Command line: run the sensor program or the word count as a stream.

    python -m pulseline sensor --path IN_DIR --out OUT_DIR [--config cfg.json]
    python -m pulseline sensor --socket HOST PORT --out OUT_DIR
    python -m pulseline words --path IN_DIR --out OUT_DIR

Without ``--once`` the queries run until stopped; with it they process what
is there (``availableNow``) and exit.
"""

from __future__ import annotations

import argparse
import json
import sys

from pulseline.config import SensorConfig

#: Lines have no number of their own; the id of a file's lines is the hash of its path.
LINE_ID = "xxhash64(_metadata.file_path)"
FEED_SECONDS = 10


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m pulseline")
    sub = p.add_subparsers(dest="program", required=True)
    for name in ("sensor", "words"):
        s = sub.add_parser(name)
        src = s.add_mutually_exclusive_group(required=True)
        src.add_argument("--path", help="folder to watch for new files")
        src.add_argument("--socket", nargs=2, metavar=("HOST", "PORT"))
        s.add_argument("--out", required=True, help="output folder (logs and checkpoints)")
        s.add_argument("--config", help="JSON file with SensorConfig fields")
        s.add_argument("--show", type=int, metavar="N", help="words: print N lines of every batch")
        s.add_argument("--one-pass", action="store_true",
                       help="sensor: all outputs from one query, bad lines to a dead-letter log")
        s.add_argument("--once", action="store_true", help="process available input and exit")
    return p


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    cfg = {}
    if args.config:
        with open(args.config) as fh:
            cfg = json.load(fh)
    if args.socket:
        cfg.update(source="socket", host=args.socket[0], port=int(args.socket[1]))
    else:
        cfg.update(source="folder", path=args.path)
    config = SensorConfig.from_dict(cfg)

    from pulseline.session import apply_cluster_settings, input_bytes, runner_session
    from pulseline.sources.lines import read_lines
    from pulseline.streaming import onepass as op
    from pulseline.streaming import queries as sq

    spark = runner_session(f"pulseline-{args.program}")
    if config.source == "folder":
        apply_cluster_settings(spark, input_bytes(spark, config.path))
    if args.program == "sensor":
        if args.one_pass:
            qs = op.start_one_pass(spark, config, args.out, available_now=args.once)
            feed = None
        else:
            qs = sq.start_from_config(spark, config, args.out, available_now=args.once)
            records = sq.configured_records(spark, config)
            feed = lambda: sq.feed_totals(spark, records, args.out, config.checkpoint)
    else:
        mode = "socket" if config.source == "socket" else "stream"
        lines = read_lines(spark, config.path, mode=mode, host=config.host, port=config.port,
                           max_files_per_trigger=config.max_files_per_trigger,
                           max_bytes_per_trigger=config.max_bytes_per_trigger)
        texts = lines.selectExpr(f"{LINE_ID if mode == 'stream' else 'CAST(NULL AS BIGINT)'} AS doc_id",
                                 "value AS text")
        how = {"available_now": args.once, "trigger": None if args.once else "1 second"}
        qs = {"words": sq.start_word_count(spark, texts, args.out, **how)}
        feed = lambda: sq.feed_word_totals(spark, texts, args.out)
        if args.show:
            qs["show"] = sq.console(texts.select("text"), args.show, **how)
    if config.source == "socket":
        feed = None  # a socket has no offsets that a second reader could take up
    if args.once:
        sq.await_all(qs)
        if feed:
            feed()
    else:
        while not any(q.awaitTermination(FEED_SECONDS) for q in qs.values()):
            if feed:
                feed()
    return 0


if __name__ == "__main__":
    sys.exit(main())

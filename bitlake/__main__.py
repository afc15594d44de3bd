"""Command line: ``python -m bitlake <command> ...`` (or via spark-submit).

    load     load unmarked files of a log folder (resumable; --refresh first
             drops this owner's marks and the index's facts and dictionaries)
    stream   the same load as Structured Streaming (runs to the end of the files)
    refresh  drop marks of this owner and/or the index
    compact  fold fact batches and dictionary batches into one each
    rollup   (re)build the bitmap rollup
    unlock   remove the mark of a job that died while it gave out ids
    query    row/range/union/intersect/difference/count/topn: all rows, printed
             or written to --out; --limit only if you want fewer
"""

from __future__ import annotations

import argparse
import json
import re
import sys

from .session import get_session
from .spec import DEFAULT_INDEX, DEFAULT_SHARD_WIDTH, IdConfig, ScanConfig


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="bitlake")
    p.add_argument("--store", required=True, help="store root (any Hadoop file system)")
    p.add_argument("--index", default=DEFAULT_INDEX)
    sub = p.add_subparsers(dest="cmd", required=True)

    def ids(sp):
        sp.add_argument("--shard-width", type=int, default=DEFAULT_SHARD_WIDTH)
        sp.add_argument("--lanes", type=int, default=1)
        sp.add_argument("--owner", type=int, default=0)
        sp.add_argument("--owners", type=int, default=1)

    ld = sub.add_parser("load")
    ld.add_argument("--root", required=True, help="log folder with dt=/part= sub-folders")
    ld.add_argument("--start-date")
    ld.add_argument("--end-date")
    ld.add_argument("--bucket-min", type=int)
    ld.add_argument("--bucket-max", type=int)
    ld.add_argument("--node-id", type=int, default=0)
    ld.add_argument("--nodes-total", type=int, default=1)
    ld.add_argument("--max-files", type=int)
    ld.add_argument("--files-per-batch", type=int, default=50_000)
    ld.add_argument("--until-done", action="store_true")
    ld.add_argument("--refresh", action="store_true")
    ld.add_argument("--rollup", action="store_true", help="keep the bitmap rollup up to date")
    ids(ld)

    st = sub.add_parser("stream")
    st.add_argument("--root", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--max-files-per-trigger", type=int, default=1000)
    st.add_argument("--start-date")
    st.add_argument("--end-date")
    st.add_argument("--bucket-min", type=int)
    st.add_argument("--bucket-max", type=int)
    st.add_argument("--node-id", type=int, default=0)
    st.add_argument("--nodes-total", type=int, default=1)
    st.add_argument("--rollup", action="store_true")
    ids(st)

    rf = sub.add_parser("refresh")
    rf.add_argument("--owner-node", type=int)
    rf.add_argument("--drop-index", action="store_true")

    sub.add_parser("compact")
    sub.add_parser("unlock")
    ru = sub.add_parser("rollup")
    ru.add_argument("--field", action="append", dest="fields", help="fields to roll up (default: all)")

    q = sub.add_parser("query")
    q.add_argument("call", choices=["row", "range", "union", "intersect", "difference", "count", "topn"])
    q.add_argument("--leaf", action="append", default=[],
                   help="field=value or field=value@start..end (repeat for set operations)")
    q.add_argument("--field")
    q.add_argument("-n", type=int)
    q.add_argument("--limit", type=int, help="print so many rows at most")
    q.add_argument("--out", help="write the answer as Parquet to this folder instead")
    return p


_WINDOW = re.compile(r"(.*)@([^@]*)\.\.([^@]*)", re.S)


def _leaf(ix, text: str):
    """``field=value`` or ``field=value@start..end``; other ``@`` belong to the value."""
    field, eq, value = text.partition("=")
    if not eq:
        raise SystemExit(f"--leaf {text!r}: field=value")
    m = _WINDOW.fullmatch(value)
    return ix.range(field, m[1], m[2], m[3]) if m else ix.row(field, value)


def _answer(ix, a):
    leaves = [_leaf(ix, t) for t in a.leaf]
    if a.call in ("row", "range") and len(leaves) != 1 or a.call == "topn" and len(leaves) > 1:
        raise SystemExit(f"{a.call} takes {'one --leaf' if a.call != 'topn' else 'one --leaf at most'}, got {len(leaves)}")
    if a.call in ("union", "intersect", "difference", "count") and not leaves:
        raise SystemExit(f"{a.call} needs a --leaf")
    if a.call == "range" and leaves[0].leaf[2] is None:
        raise SystemExit("range needs --leaf field=value@start..end")
    if a.call == "topn":
        return ix.topn(a.field, a.n, filter=leaves[0] if leaves else None)
    if a.call == "count":
        return ix.count(ix.union(*leaves) if len(leaves) > 1 else leaves[0])
    return ix.columns(leaves[0] if a.call in ("row", "range") else getattr(ix, a.call)(*leaves))


def main(argv=None) -> int:
    a = _parser().parse_args(argv)
    from .plans.store import BitStore
    spark = get_session()
    store = BitStore(spark, a.store)
    if a.cmd in ("load", "stream"):
        cfg = IdConfig(shard_width=a.shard_width, lanes=a.lanes, owner=a.owner, n_owners=a.owners)
    if a.cmd == "load":
        from .streaming.load import run_load
        if a.refresh:
            store.refresh_marks(a.index, a.node_id)
            store.refresh_index(a.index)
        scan = ScanConfig(a.start_date, a.end_date, a.bucket_min, a.bucket_max, a.node_id, a.nodes_total,
                          a.max_files)
        reps = run_load(spark, store, root=a.root, index=a.index, scan=scan, cfg=cfg,
                        owner_node=a.node_id, until_done=a.until_done, rollup=a.rollup,
                        files_per_batch=a.files_per_batch)
        print(json.dumps(reps))
    elif a.cmd == "stream":
        from .streaming.load import stream_load
        scan = ScanConfig(a.start_date, a.end_date, a.bucket_min, a.bucket_max, a.node_id, a.nodes_total)
        stream_load(spark, store, a.root, a.checkpoint, index=a.index, scan=scan, cfg=cfg, owner_node=a.node_id,
                    max_files_per_trigger=a.max_files_per_trigger, rollup=a.rollup)
    elif a.cmd == "refresh":
        if a.owner_node is not None:
            store.refresh_marks(a.index, a.owner_node)
        if a.drop_index:
            store.refresh_index(a.index)
    elif a.cmd == "compact":
        store.compact_facts(a.index)
        store.compact_dicts(a.index)
    elif a.cmd == "unlock":
        print(store.release_writer(a.index))
    elif a.cmd == "rollup":
        print(store.write_rollup(a.index, a.fields))
    elif a.cmd == "query":
        out = _answer(store.index(a.index), a)
        out = out if a.limit is None else out.limit(a.limit)
        if a.out:
            out.write.parquet(a.out)
        else:
            for r in out.toLocalIterator():  # a partition at a time
                print("\t".join("" if v is None else str(v) for v in r))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Log layout and id-generation parameters."""

from __future__ import annotations

from dataclasses import dataclass

DEFAULT_INDEX = "_test"

# Fixed values that must equal the reference for the same results:
# TAB-separated line, positions 0..4 = ts, idfield, cfield, ofield, sfield_list;
# the list is comma-separated; time layout "2006-01-02 15:04:05" (UTC);
# shard width 1,048,576 = 2^20; default index name "_test".
DEFAULT_SHARD_WIDTH = 1 << 20


@dataclass(frozen=True)
class LogSpec:
    """Where each attribute sits in a TAB-separated log line."""

    ts_pos: int = 0
    id_pos: int = 1
    scalar_fields: tuple = (("cfield", 2), ("ofield", 3))
    list_fields: tuple = (("sfield", 4),)
    # Spark datetime pattern equivalent of the Go layout; a fraction and a
    # one-digit hour are accepted as Go's parser does.
    ts_format: str = "yyyy-MM-dd H:mm:ss[.SSSSSSSSS]"
    sep: str = "\t"
    list_sep: str = ","

    @property
    def fields(self) -> tuple:
        return tuple(n for n, _ in self.scalar_fields) + tuple(n for n, _ in self.list_fields)

    @property
    def min_positions(self) -> int:
        pos = [self.ts_pos, self.id_pos] + [p for _, p in self.scalar_fields] + [p for _, p in self.list_fields]
        return max(pos) + 1

    def check_field(self, name: str) -> str:
        if not isinstance(name, str):
            raise TypeError(f"field must be a string, got {type(name).__name__}")
        if name not in self.fields:
            raise ValueError(f"unknown field {name!r}; known: {', '.join(self.fields)}")
        return name


@dataclass(frozen=True)
class IdConfig:
    """Column-id layout: ``lanes`` shards are filled round-robin so that new
    ids never pile onto one shard; ``owner`` of ``n_owners`` separate jobs each
    open only shards with ``shard % n_owners == owner``."""

    shard_width: int = DEFAULT_SHARD_WIDTH
    lanes: int = 1
    owner: int = 0
    n_owners: int = 1
    rows_per_rank_bucket: int = 50_000

    def __post_init__(self):
        if self.shard_width < 1:
            raise ValueError("shard_width must be >= 1")
        if self.lanes < 1:
            raise ValueError("lanes must be >= 1")
        if self.n_owners < 1:
            raise ValueError("n_owners must be >= 1")
        if not 0 <= self.owner < self.n_owners:
            raise ValueError("owner must be in [0, n_owners)")


@dataclass(frozen=True)
class ScanConfig:
    """File selection for one load run (all bounds inclusive)."""

    start_date: str | None = None
    end_date: str | None = None
    bucket_min: int | None = None
    bucket_max: int | None = None
    node_id: int = 0
    nodes_total: int = 1
    max_files: int | None = None

    def __post_init__(self):
        if self.nodes_total < 1:
            raise ValueError("nodes_total must be >= 1")
        if not 0 <= self.node_id < self.nodes_total:
            raise ValueError("node_id must be in [0, nodes_total)")
        if self.max_files is not None and self.max_files < 0:
            raise ValueError("max_files must be >= 0")

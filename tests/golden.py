"""The golden mini-log of FIXTURES.md section 3, written as gzip files."""

import gzip
import os

T = "\t"
LINES = {
    "dt=2018-07-01/part=0/a.gz": [
        f"2018-07-01 10:00:00{T}u1{T}c1{T}o1{T}a,b",
        f"2018-07-01 23:59:59{T}u2{T}c1{T}o2{T}b",
        f"2018-07-01 10:00:00{T}u1{T}c1{T}o1{T}a,b",
    ],
    "dt=2018-07-01/part=1/b.gz": [
        f"2018-07-01 11:00:00{T}u3{T}c2{T}o1{T}",
        f"not-a-time{T}u4{T}c2{T}o2{T}c",
        f"2018-07-01 12:00:00{T}u5{T}c2{T}o1",
    ],
    "dt=2018-07-02/part=0/c.gz": [
        f"2018-07-02 00:00:00{T}u1{T}c2{T}o1{T}a,,a",
        f"2018-08-01 00:00:00{T}u2{T}c1{T}o1{T}c{T}extra",
    ],
}
BATCH2 = {"dt=2018-07-03/part=0/d.gz": [f"2018-07-03 01:00:00{T}u6{T}c1{T}o1{T}a",
                                        f"2018-07-03 02:00:00{T}u7{T}c1{T}o1{T}a"]}
BATCH3 = {"dt=2018-07-04/part=0/e.gz": [f"2018-07-04 01:00:00{T}u8{T}c3{T}o3{T}d"]}


def write(root, files):
    for rel, lines in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with gzip.open(p, "wt", encoding="utf-8", newline="") as f:
            for ln in lines:
                f.write(ln + "\n")
    return root

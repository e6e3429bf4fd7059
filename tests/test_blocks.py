import bz2
import glob
import io
import lzma
import os
import random

import pytest
from pyspark.sql import functions as F

from tracemill.operators import blocks as B, long_archives
from tracemill.operators.codecs import Limits
from tracemill.session import shared_dir
from tracemill.sources.files import list_files


def noise(n, seed=1):
    rng = random.Random(seed)
    return b"".join(rng.choice([b"word ", b"line\n", bytes([rng.randrange(256)])]) for _ in range(n))


@pytest.mark.parametrize("level", [1, 9])
def test_bzip2_blocks(level):
    data = noise(200_000)
    packed = bz2.compress(data, level) + bz2.compress(b"second stream", level) + bz2.compress(b"")
    raw, found = io.BytesIO(packed), []
    for start in range(0, len(packed), 50_021):
        found += B.find_marks(raw, start, min(len(packed), start + 50_021))
    assert found == B.find_marks(raw, 0, len(packed))
    begins = [p for p, block in found if block]
    ends = [next(q for q, _ in found if q > p) for p in begins]
    assert len(begins) >= (5 if level == 1 else 2) and (level == 9 or any(p % 8 for p in begins))
    assert b"".join(B.bzip2_run(raw, begins, ends)) == data + b"second stream"
    assert b"".join(B.bzip2_block(raw, b, e) for b, e in zip(begins, ends)) == data + b"second stream"


def test_a_chance_mark_is_part_of_its_block():
    data = noise(100_000)
    packed = bz2.compress(data, 1)
    raw = io.BytesIO(packed)
    found = B.find_marks(raw, 0, len(packed))
    begins = [p for p, block in found if block]
    ends = [next(q for q, _ in found if q > p) for p in begins]
    chance = begins[0] + 5001
    begins, ends = [begins[0], chance, *begins[1:]], [chance, *ends]
    assert b"".join(B.bzip2_run(raw, begins, ends)) == data
    with pytest.raises(ValueError, match="damaged"):
        list(B.bzip2_run(io.BytesIO(packed[:4000] + b"\0" * 90 + packed[4090:]), begins, ends))


def many_blocks(data, size):
    """An xz file of several streams, as tools that work in parallel write; padded between."""
    return b"".join(lzma.compress(data[k : k + size], preset=0) + b"\0" * (4 * (k % 3)) for k in range(0, len(data), size))


def test_xz_blocks():
    data = noise(60_000)
    packed = many_blocks(data, 40_000)
    raw = io.BytesIO(packed)
    found = B.xz_blocks(raw, len(packed))
    assert len(found) == -(-len(data) // 40_000) and sum(f[3] for f in found) == len(data)
    assert b"".join(B.xz_block(raw, *f) for f in found) == data
    with pytest.raises(ValueError, match="damaged"):
        B.xz_blocks(io.BytesIO(packed[:-1]), len(packed) - 1)


def test_short_runs_share_a_task(spark, tmp_path):
    """What comes out of 40 streams is written in some hundred runs, by far fewer tasks."""
    data = [noise(8_000, seed=k) for k in range(40)]
    for k, d in enumerate(data):
        (tmp_path / f"s{k}.{'xz' if k % 2 else 'bz2'}").write_bytes(many_blocks(d, 4_000) if k % 2 else bz2.compress(d, 1))
    spill = shared_dir(spark, "spill")
    listed = list_files(spark, str(tmp_path)).withColumn("depth", F.lit(0))
    limits = Limits(row_bytes=1 << 30, spill=spill)
    found = long_archives.unpack_long(listed, limits, min_bytes=1, run_bytes=1 << 9)
    assert {r["name"]: bytes(r["content"]) for r in found.collect()} == {f"s{k}": d for k, d in enumerate(data)}
    done = max(glob.glob(f"{os.path.dirname(spill)}/runs-done-*"), key=os.path.getmtime)
    assert spark.read.parquet(done).count() > 60 and len(glob.glob(f"{done}/part-*")) <= 4

"""Memory that a task leaves behind in its Python worker."""

import re
from pathlib import Path

import pyarrow as pa
import pytest

from skylattice.llm.rows import releasing


@pytest.mark.parametrize("given_back", [True, False])
def test_a_task_gives_back_what_it_freed(spark, given_back):
    def held():
        text = Path("/proc/self/smaps_rollup").read_text()
        return int(re.search(r"\nPss_Anon:\s+(\d+)", text).group(1)) / 1024

    def work(batches):
        for _ in batches:
            pieces = [bytes(2000) for _ in range(100_000)]
            kept.append(pieces[-1])  # above the others, so the C library keeps what lies below it
            yield pa.RecordBatch.from_arrays([pa.array([held()])], names=["mb"])

    def both(batches):
        """A task and the wait after it, in one worker."""
        batches = list(batches)
        for batch in task(batches):
            during = batch.column("mb")[0].as_py()
        yield pa.RecordBatch.from_arrays([pa.array([during - held()])], names=["mb"])

    kept = []
    task = releasing(work) if given_back else work
    freed = spark.range(1, numPartitions=1).mapInArrow(both, "mb double").first()[0]
    assert (freed > 150) == given_back

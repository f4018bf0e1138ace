"""Time and memory of listing a folder of many empty files: python scripts/listing.py 20000 100000"""

from __future__ import annotations

import os
import resource
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stratalake.session import get_spark  # noqa: E402
from stratalake.sources.storage import list_files  # noqa: E402


def main() -> None:
    folder = tempfile.mkdtemp(prefix="listing-")
    conf = {"spark.ui.enabled": "false", "spark.driver.memory": "1g", "spark.checkpoint.dir": f"{folder}/shared"}
    spark = get_spark("listing", master="local[4]", conf=conf)
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    for files in map(int, sys.argv[1:]):
        root = Path(folder, str(files))
        for i in range(files):
            if i % 10_000 == 0:
                os.makedirs(root / str(i // 10_000))
            (root / str(i // 10_000) / f"{i}.csv").touch()
        start = time.perf_counter()
        found = list_files(spark, str(root)).count()
        seconds = time.perf_counter() - start
        runtime.gc()
        heap = (runtime.totalMemory() - runtime.freeMemory()) / 2**20
        own = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
        print(f"{found} files: {seconds:.1f} s, Python {own:.0f} MB, live heap {heap:.0f} MB", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

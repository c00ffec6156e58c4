"""python tests/check_all.py FOLDER [key ...]: compare all or the named queries."""

import sys
import time

sys.path[:0] = [__file__.rsplit("/tests/", 1)[0], __file__.rsplit("/", 1)[0]]

from oracle import compare  # noqa: E402

from cardwatch.plans import ORACLES, QUERIES  # noqa: E402
from cardwatch.session import build_session  # noqa: E402

if __name__ == "__main__":
    folder, keys = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    failed = []
    for key in keys or QUERIES:
        start = time.time()
        try:
            if key in ORACLES:
                text = compare(spark, folder, key, QUERIES[key], ORACLES[key])
            else:
                text = "" if QUERIES[key](spark, folder).collect() else "no rows"
        except Exception as e:  # noqa: BLE001
            text = f"{type(e).__name__}: {str(e)[:600]}"
        if text:
            failed.append(key)
        print(f"{'FAIL' if text else 'ok'} {key} {time.time() - start:.1f}s {text[:1200]}", flush=True)
    print(len(failed), "failed", failed)

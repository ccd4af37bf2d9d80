"""Print the formatted physical plan of registered queries (optionally after a run,
to see AQE's final plan).

usage: python tools/explain.py [sf_dir] name [name ...] [--run]
"""

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from panelkit.plans import QUERIES  # noqa: E402
from panelkit.session import get_spark  # noqa: E402


def main():
    args = [a for a in sys.argv[1:] if a != "--run"]
    run = "--run" in sys.argv
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")]
    spark = get_spark("local[8]", shuffle_partitions=16)
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        if run:
            df.write.format("noop").mode("overwrite").save()
        print(f"===== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()

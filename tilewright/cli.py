"""python -m tilewright.cli COMMAND [--config FILE] ...

run, export, validate, probe, inspect, diagnose, artworks, records, benchmark, clean.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime

from pyspark.sql import functions as F

from tilewright.plans.benchmark import benchmark, ranking
from tilewright.plans.pipeline import Config, Pipeline
from tilewright.session import session
from tilewright.sources.store import append_log, clean_temporary

COMMANDS = ["run", "export", "validate", "probe", "inspect", "diagnose", "artworks", "records", "benchmark", "clean"]


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tilewright", description=__doc__)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--config")
    parser.add_argument("--root")
    parser.add_argument("--from", dest="first", type=datetime.fromisoformat)
    parser.add_argument("--to", dest="last", type=datetime.fromisoformat)
    parser.add_argument("--limit", type=int)
    parser.add_argument("--no-export", action="store_true")
    parser.add_argument("--tag")
    parser.add_argument("--grow", type=int, default=3, help="radius by which drawings grow together")
    parser.add_argument("--least-pixels", type=int, default=20)
    parser.add_argument("--per-folder", type=int, default=5000, help="images in a numbered folder")
    parser.add_argument("--all-images", action="store_true", help="write images that are there already once more")
    parser.add_argument("--samples", type=int, default=20)
    parser.add_argument("--deep", action="store_true", help="compare the tile index with the pixels")
    parser.add_argument("--only-missing", action="store_true", help="leave out shards that the report calls ok")
    parser.add_argument("--repeats", type=int, default=3)
    parser.add_argument("--out")
    a = parser.parse_args(argv)
    try:
        config = Config.load(a.config, root=a.root)
        if a.command == "clean":
            print(clean_temporary(config.root))
            return 0
        pipeline = Pipeline(session(), config)
        if a.command == "run":
            print("\n".join(pipeline.run(a.first, a.last, a.limit, not a.no_export)))
        elif a.command == "export":
            print(*pipeline.export(f"{config.root}/export"))
        elif a.command == "validate":
            n = 0
            for row in pipeline.validate(a.deep).toLocalIterator():
                print(f"{row['rule']}: {row['item']}")
                n += 1
            print(f"{n} violations")
            return 1 if n else 0
        elif a.command == "probe":
            report = a.out or f"{config.root}/probe/{a.tag}"
            found = (pipeline.pending_probes(a.tag, report) if a.only_missing else pipeline.probe(a.tag)).persist()
            append_log(found.select("name", "ok", "tiles", "before", "overlaid", "after"), report)
            sums = found.agg(F.count("*").alias("shards"), F.count_if(~F.col("ok")).alias("failures")).first()
            print(json.dumps({**sums.asDict(), "ok": not sums["failures"], "report": report}))
            return 1 if sums["failures"] else 0
        elif a.command == "inspect":
            print(json.dumps(pipeline.inspect(a.tag, a.samples), indent=1))
        elif a.command == "diagnose":
            print(json.dumps(pipeline.diagnostics(a.tag, a.out or f"{config.root}/diagnostics", a.samples), indent=1))
        elif a.command == "records":
            print(pipeline.records(a.out or f"{config.root}/records"))
        elif a.command == "benchmark":
            results = benchmark(pipeline, a.repeats)
            out = a.out or f"{config.root}/benchmark"
            results.write.mode("overwrite").option("partitionOverwriteMode", "static").json(f"{out}/jsonl")
            results.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").option("header", True).csv(f"{out}/csv")
            ranking(results).show(truncate=False)
        else:
            print(json.dumps(pipeline.artworks(a.out or f"{config.root}/artworks", a.grow, a.least_pixels, a.per_folder, not a.all_images)))
    except Exception as e:
        print(f"ERROR: {type(e).__name__}: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""spark-submit entry point for the enrichment job (flags: see geoweave/plans/cli.py)."""

from geoweave.plans.cli import main

if __name__ == "__main__":
    raise SystemExit(main())

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"

# Optional folder holding the lending workload's own sample CSVs (loans,
# credit, months, scheduled repayments).  Each table's file is found by its
# header line; tests that need one are skipped when it is not available.
SAMPLE_DIR = os.environ.get("LEDGERLINE_SAMPLE_DIR")


def sample_csv(table: str) -> str:
    from ledgerline.sources.schemas import SCHEMAS
    header = ",".join(SCHEMAS[table].names)
    if SAMPLE_DIR and os.path.isdir(SAMPLE_DIR):
        for root, _, files in os.walk(SAMPLE_DIR):
            for f in sorted(files):
                if f.lower().endswith(".csv"):
                    path = os.path.join(root, f)
                    with open(path, newline="") as fh:
                        if fh.readline().strip() == header:
                            return path
    pytest.skip(f"no sample CSV for {table} (set LEDGERLINE_SAMPLE_DIR)")


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import get_session
    s = get_session("local[*]", 8, app_name="ledgerline-tests")
    yield s


def rows(df, *cols):
    """Collect selected columns as a list of tuples (test helper)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]

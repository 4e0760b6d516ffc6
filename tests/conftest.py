from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from reefcensus.session import checkpoint_dir, get_session

    s = get_session("local[4]", 4)
    checkpoint_dir(s)
    yield s


def write_csv(dirpath: Path, name: str, text: str) -> Path:
    p = dirpath / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text)
    return p


def rows(df, *cols):
    """Collected rows as tuples of the named columns, sorted (None first)."""
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is not None, str(x)) for x in t))


def ordered(items):
    """Expected rows in the order ``rows`` returns them."""
    return sorted(items, key=lambda t: tuple((x is not None, str(x)) for x in t))

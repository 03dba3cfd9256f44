import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

ROOT = "/root/testdata/sf0.001"
# Columns that operators use for results or inside; inputs may have them too.
CLASHES = ["kept", "keep_id", "size", "row", "digest", "n", "h", "taken", "host", "target", "of", "spans", "region", "u", "v"]


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text) of crafted texts: nulls, empty, short, long, equal, nearly equal and repeating ones."""
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(400)] + ["Éé", "日本", "x.y", "A1"]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "One"), (5, "one two"), (6, "a b c d e"), (7, "A B c d e f"), (8, None), (9, "...")]
    for k in range(10, 40):
        rows.append((k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 160)))))
    for k in range(40, 60):
        copy = rows[10 + k % 7][1].split(" ")
        for _ in range(rng.randrange(0, 3)):
            copy[rng.randrange(len(copy))] = "changed"
        rows.append((k, " ".join(copy)))
    for k in range(60, 75):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 90))]
        at = rng.randrange(len(own) + 1)
        rows.append((k, "  ".join(own[:at] + passage[: rng.randrange(45, 71)] + own[at:])))
    rows.append((75, " ".join(rng.choice(vocabulary) for _ in range(30_000))))
    rows.append((76, rows[75][1].upper()))
    rows.append((77, "z" * 200_000))
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(d, t, ["en", None, "de"][d % 3], ["b", "a", None, "c"][d % 4], *[f"{c}{d}" for c in CLASHES]) for d, t in texts]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame(rows, schema).repartition(5)

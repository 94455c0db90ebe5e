"""A small table with every awkward case, and plain forms of what the operators count."""

import re
import string

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"long{i % 997}x{i}" for i in range(20_000))
PASSAGE = " ".join(f"pass{i}" for i in range(60))
BASE = " ".join(f"w{i}" for i in range(200))

TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "One two",
    "one  TWO",
    BASE,
    BASE,
    BASE.replace("w7 ", "x7 "),
    BASE.replace("w7 ", "x7 ").replace("w150 ", "y150 "),
    "before " + PASSAGE + " after",
    "another start " + PASSAGE + " another end " + PASSAGE,
    "é ñ ß 漢字 😀 <|endoftext|> \x1c end",
    LONG,
    LONG + " more",
    "a " * 100,
    "line one here\nline one here\n\nline two",
]

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, n int, count long, label string, hash string, component string, start string"


def awkward(spark, texts=None):
    """Documents with repeated rows and extra columns whose names operators use inside."""
    texts = TEXTS if texts is None else texts
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"src{i % 3}", None if t is None else len(t), 1, 2, "l", "h", "c", "s") for i, t in enumerate(texts)]
    if len(rows) > 6:
        rows.append(rows[6])
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def words(text):
    return WORD.findall(text or "")


def by_id(frame):
    """Rows by doc_id; equal for repeated rows."""
    out = {}
    for r in frame.collect():
        assert out.setdefault(r["doc_id"], r) == r
    return out

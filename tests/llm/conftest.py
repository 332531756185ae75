import random

import pytest

NAMES = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that the operators use inside; a table may hold them too.
CLASHES = ["id", "key", "fp", "word", "words", "line", "at", "n", "m", "c", "h", "bytes", "bits", "block", "set", "quality", "spans", "held_out", "piece", "n_words", "item_id", "__text_key", "_key_of_text", "__quality", "__verdict", "limits", "verdict", "_id", "_key", "__id", "__gone", "__text"]


def _corpus() -> list[tuple]:
    r = random.Random(5)
    syllables = ["ta", "ri", "mo", "kel", "éa", "ßu", "lin", "or", "ny", "va", "du", "sce", "pä", "tion", "ing"]
    pool = ["".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(400)]

    def prose(n):
        out = [r.choice(pool) for _ in range(n)]
        return " ".join(w + ("." if k % 11 == 10 else "") for k, w in enumerate(out))

    def document():
        return "\n".join(prose(r.randint(1, 40)) for _ in range(r.randint(1, 6)))

    shared = prose(70)
    rows = [[i, document(), r.choice(["en", "de", "fr"]), r.choice(["a", "b"])] for i in range(40)]
    for k in range(40, 60):  # copies, near copies, shared passages
        base = rows[r.randrange(40)][1]
        words = base.split(" ")
        if k % 3:
            words[r.randrange(len(words))] = "changed"
        rows.append([k, " ".join(words) if k % 4 else f"{prose(9)} {shared} {prose(k % 7 + 1)}", "en", "a"])
    rows += [
        [60, None, "en", "a"], [61, "", None, "b"], [62, " \n\t\x0b\n ", "de", None], [63, "\n\n", "de", "a"], [None, shared, "en", "a"], [None, shared, "en", "a"],
        [None, None, None, None], [64, "x", "en", "a"], [65, "x", "en", "a"], [66, "ab " * 3000, "en", "b"], [67, "a" * 900, "en", "b"], [68, "a" * 1000 + " b", "fr", "b"],
        [3, rows[3][1], rows[3][2], rows[3][3]], [3, rows[3][1], rows[3][2], rows[3][3]], [4, rows[5][1], "en", "a"], [69, prose(6000), "de", "a"],
        [70, f"mail ab.c@mail.example.com, 10.0.0.1 and +1 (702) 555-0742 or 4539 1488 0343 6467; {prose(60)}", "en", "a"], [71, "日本語 ١٢٣ ½ é1@x.y token: 'abcdef123456' AKIA" + "Z9" * 9, "en", "b"],
        [72, "secret:token:abcdefg " + "0f" * 20 + " Zx9Qw3Er7Ty1Ui5Op2As4Df6Gh8Jk0 end", "en", "a"], [73, (prose(5) + "\n") * 30, "fr", "a"], [74, "###$$$ " * 80, "fr", "b"],
        [75, "plain\r\ntext\rwith\x0codd\x1cbreaks\x85and more words " + prose(60), "en", "b"],
    ]
    return [tuple(x) for x in rows]


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    return _corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    table = spark.createDataFrame([(*x, len(x[1] or "")) for x in rows], NAMES)
    for k, name in enumerate(CLASHES):
        table = table.selectExpr("*", f"cast({k} as int) as {name}" if k % 2 else f"cast(null as string) as {name}")
    return table.repartition(3)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)

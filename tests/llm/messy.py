"""Small documents with everything that an operator must bear."""

import random

LONG = " ".join(f"word{k % 997}" for k in range(30_000))
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, language string, path string"


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def rows() -> list[tuple]:
    texts = [
        None,
        "",
        "   \n\t ",
        "one",
        "one",
        "1234 !!! 5678",
        words(1, 60),
        words(1, 60),
        words(1, 60).replace("a", "A"),
        words(1, 57) + " x y z",
        words(2, 400),
        words(2, 400) + " end",
        LONG,
        LONG + " tail",
        "日本語のテキスト 😀 é​ \0 zero <|endoftext|> <s> ▁",
        "x" * 5000,
        'token = "abcdef123456"\nplain line of text here\n' + "plain line of text here\n" * 3,
    ]
    out = [(k, t, ["en", "de", None][k % 3], ["b", "a", None, ""][k % 4], 7, 0.5, "clash", "p") for k, t in enumerate(texts)]
    out += [out[6], out[6], out[3]]  # repeated rows
    out.append((None, words(1, 60), "en", "a", None, None, None, None))
    out.append((None, None, None, None, None, None, None, None))
    return out


def docs(spark):
    return spark.createDataFrame(rows(), COLUMNS)


def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)

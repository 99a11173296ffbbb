"""Texts that the operators' tests share."""

import random

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves.
CLASHING = "doc_id long, text string, rest string, key string, n_lines string, score string, `Words` string, doc string, label int, `a.b` int, `a b` string, _dropped string"


def prose(seed: int, words: int, vocabulary: int = 3000) -> str:
    r = random.Random(seed)
    names = ["".join(random.Random(k).choices("abcdefghijklmnoprstuvz", k=2 + k % 8)) for k in range(vocabulary)]
    return " ".join(r.choices(names, k=words))


def awkward_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, ties and repeated rows."""
    line = "This line is held by several documents."
    long_text = "\n".join(prose(k, 40) for k in range(400))
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (None, "A text without an id.\n" + line),
        (None, None),
        (5, line + "\nAnd one of its own, which nobody else has."),
        (6, "  " + line.upper() + "\t\r\n\n" + line),
        (7, line),
        (7, line),
        (8, long_text),
        (9, long_text),
        (10, "short"),
        (11, "a  b   c   d e <|endoftext|> é. Ünïcode, 日本語のテキスト 🙂 ΣΑΣ it's"),
        (12, "x" * 30_000),
        (13, line + " \x00 odd"),
        (14, "▁ "),
        (15, "a▁ b"),
        (16, " ▁ ▁"),
        (17, "▁▁  ▁ a ▁b▁  c"),
    ]

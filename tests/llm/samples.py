"""Small documents with every odd case."""

from __future__ import annotations

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
LINE = "a line that is shared by several documents"


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i * (seed + 3) + i) % len(WORDS)] + str((seed * 31 + i * 17) % 97) for i in range(n))


def rows() -> list[tuple]:
    long = "\n".join(prose(90 + k, 400) for k in range(60))
    texts = {
        1: prose(1, 60), 2: prose(1, 60).upper(), 3: prose(1, 59) + " changed", 4: None, 5: "", 6: long, 7: long, 8: long + " end",
        9: f"{LINE}\nown line nine is here\n{LINE}", 10: f" {LINE.upper()}\t\nown line ten is here", 11: f"x\n{LINE}\r\n", 12: LINE,
        13: "mail bob.x@mail.example.com or +49 170 1234567, ip 10.0.0.7, card 4111 1111 1111 1111.",
        14: "🙂 ünïcödé 日本語 " * 5, 15: "\n\n\n", 16: " \t ", 17: "word", 18: "a" * 30000, 19: prose(19, 30) + "\n" + prose(19, 30), 20: prose(1, 60),
    }
    out = [(i, t, "en" if i % 3 else None, "s", 0) for i, t in texts.items()]
    return [*out, (20, texts[20], "xx", "s", 0), (None, prose(55, 40), "en", "s", 0), (None, prose(1, 60), "en", None, None)]

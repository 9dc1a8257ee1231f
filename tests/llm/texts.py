"""Texts with unusual characters, shared by the tokenizer tests."""

import random

NASTY = ["", " ", "\n\t", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "<|endoftext", "it's WE'LL don't 12345 x²½ ٣٤",
         "ΣΑΣ σς İI ﬁ é é Å", "a b c\x85d\x1ce\x1df​g‍h", "日本語テキスト 한국어 😀👍🏽", "\x00\x01\x7f",
         "…“quoted”—dash", "aaaaaaaaaaaaaaaa bbbbbbb abababababab", "x" * 3000, "don't'S 'LL", "﻿bom ᠎", "ẞ ŉ ǰ Ǆ ǅ ᾳ ᾼ",
         "a  b", " a b ", "a \n b", "a\n b", "a b \n\n", "a.\nB c,\nD", "\nx", "x\n", "a\tb \tc", "« a »", "a. b, c; d: e! f?",
         "1. 2, 3a. a3, '. ., ,", "end.\n"]


def random_texts(n: int, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    ranges = [(32, 127), (32, 127), (9, 14), (0xA0, 0x250), (0x300, 0x3FF), (0x1F00, 0x2100), (0x3000, 0x3100),
              (0x1F600, 0x1F650)]
    return ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(1, 60))) for _ in range(n)]

"""Token ids of whole texts by the public vocabulary files, fast and as the libraries give them."""

from __future__ import annotations

import base64
import json
import os
import re
from functools import lru_cache

import numpy as np

from surveyloom.llm.bpe import DIGIT, LETTER, PATTERN, PLAIN, byte_alphabet

# Stands for the end of a word; texts that hold it take the library's own way.
END = "\x00"
SPACE = r"\t-\r \x85\xa0"
LOWER = LETTER.replace("A-Z", "").replace("À-ÖØ-ö", "ß-ö")
# Fixed value: the pre-token pattern of the word vocabulary, over lower-case characters of PLAIN.
WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LOWER}]+|[{DIGIT}]|[^{SPACE}{LOWER}{DIGIT}]+"
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordCoder:
    """Ids by a lower-casing vocabulary whose merges end words with ``</w>``.

    Texts of Latin-1 characters are cut into words here and encoded with the merge list as a list of
    ranks, the end of a word being one more byte; other texts, and any vocabulary of another make, go
    through the tokenizers library itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the other cores belong to other tasks
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.coder.no_truncation()
        self.coder.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        self.fast = None
        if spec["model"].get("end_of_word_suffix") == "</w>" and split == WORD_SPLIT:
            self.fast, self.ids = self._ranked(spec["model"])
        self.words, self.plain = re.compile(WORD_PATTERN).findall, re.compile(PLAIN).fullmatch

    @staticmethod
    def _ranked(model: dict):
        import tiktoken

        alphabet, vocab = byte_alphabet(), model["vocab"]
        letters = {b: c for c, b in alphabet.items()}
        ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 0]): 256 + b for b in range(256)}
        ids = [vocab[letters[b]] for b in range(256)] + [vocab[letters[b] + "</w>"] for b in range(256)]
        for pair in model["merges"]:
            token = pair.replace(" ", "") if isinstance(pair, str) else "".join(pair)
            ends = token.endswith("</w>")
            data = bytes(alphabet[c] for c in (token[:-4] if ends else token)) + b"\0" * ends
            if data not in ranks:
                ranks[data] = len(ids)
                ids.append(vocab[token])
        return tiktoken.Encoding("words", pat_str="[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={}), np.array(ids, np.uint32)

    def encode(self, text: str) -> np.ndarray:
        """Ids without special tokens around the text."""
        if self.fast is None or not self.plain(text) or END in text or "<|" in text:
            return np.array(self.coder.encode(text, add_special_tokens=False).ids, np.uint32)
        words = self.words(text.lower())
        return self.ids[self.fast.encode_to_numpy(END.join(words) + END)] if words else self.ids[:0]


@lru_cache(maxsize=2)
def word_coder(path: str) -> WordCoder:
    return WordCoder(path)


@lru_cache(maxsize=2)
def rank_coder(path: str):
    """A tiktoken encoding over a file of ranks, without special tokens."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

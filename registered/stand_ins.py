"""Stand-ins for a caller's hosted models."""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np

from shelfmark.functions import rules
from shelfmark.operators.embedding import Embedder
from shelfmark.operators.model import Model, Request

REMEMBERED = 200_000


def rule_model(settings: dict) -> Model:
    """A stand-in for a hosted model: tags the words of the allowed values it sees.

    Categories without a hit are left out of the answer, as a real model may.
    """
    patterns = {
        category: [
            (value, re.compile(rf"\b{re.escape(value.split()[0].lower())}\b")) for value in values
        ]
        for category, values in sorted(rules.MODEL_TAGS.items())
    }

    def answer(request: Request) -> str:
        text = request.description.lower()
        found = {
            category: [value for value, pattern in options if pattern.search(text)]
            for category, options in patterns.items()
        }
        return "```" + json.dumps({key: hits for key, hits in found.items() if hits}) + "```"

    return lambda requests: [answer(request) for request in requests]


def hashed_words(dim: int = 64) -> Embedder:
    """A stand-in for a hosted embedding model: hashed word counts of unit length.

    A word is a run of characters other than blanks and line breaks, in lower
    case; its slot is the first 32 bits of its MD5 modulo ``dim``.
    """
    slots: dict[str, int] = {}  # of REMEMBERED words at most; beyond it the memory is emptied

    def slot(word: str) -> int:
        found = slots.get(word)
        if found is None:
            if len(slots) >= REMEMBERED:
                slots.clear()
            found = slots[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dim
        return found

    def embed(texts: list[str]) -> np.ndarray:
        rows = np.zeros((len(texts), dim))
        for row, text in zip(rows, texts):
            words = [slot(word) for word in re.split("[ \n]+", text.lower()) if word]
            row += np.bincount(words, minlength=dim) if words else 0
        length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        return np.divide(rows, length, out=rows, where=length > 0)

    return embed

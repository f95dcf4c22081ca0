"""Tag vocabularies, flag rules and request texts, kept as data."""

from __future__ import annotations

import re

# ---------------------------------------------------------------------------
# Results depend on these words, names and their order.
# ---------------------------------------------------------------------------

# Tags matched between word boundaries on cleaned text.
BOUNDED_TAGS = {
    "occasion_type": ["christmas", "birthday", "holiday", "everyday", "special treat"],
    "age_range": ["preschool", "kids", "teenagers", "adults"],
    "theme_type": ["adventure", "animals", "cars", "trucks", "fantasy", "space", "superheroes"],
    "skill_level": ["beginner", "intermediate", "advanced"],
    "play_style": [
        "building", "construction", "imaginative", "action", "adventure", "strategy", "puzzle",
    ],
    "franchise_type": ["star wars", "harry potter", "marvel", "dc", "comics", "disney", "pixar"],
    "product_type": [
        "building sets", "vehicles", "minifigures", "accessories", "books", "Comics",
    ],
}

# Tags matched anywhere in cleaned text; these feed the gold table.
SUBSTRING_TAGS = {
    "occasion_type": [
        "christmas", "birthday", "holiday", "everyday", "special", "treat", "gift",
    ],
    "age_range": ["preschool", "kids", "teenagers", "adults"],
    "theme_type": ["adventure", "animals", "cars", "trucks", "fantasy", "space", "superheroes"],
    "skill_level": ["beginner", "intermediate", "advanced"],
    "play_type": [
        "building", "construction", "imaginative", "action", "adventure", "strategy", "puzzle",
    ],
    "franchise_type": ["star wars", "harry potter", "marvel", "dc comics", "disney", "pixar"],
    "product_type": [
        "building", "sets", "vehicles", "minifigures", "accessories", "books", "comics",
    ],
}

# Cascade on lowercased, uncleaned text: a later category overrides an earlier one.
CASCADE_TAGS = {
    "occasion": ["christmas", "birthday", "holiday", "everyday", "special", "treat"],
    "age_range": ["preschool", "kids", "teenagers", "adults"],
    "theme": ["adventure", "animals", "cars and trucks", "fantasy", "space", "superheroes"],
    "skill_level": ["beginner", "intermediate", "advanced"],
    "play_style": [
        "building", "construction", "imaginative", "play", "action", "adventure", "strategy",
        "puzzle",
    ],
    "franchise": ["star wars", "harry", "potter", "marvel", "dc", "comics", "disney", "pixar"],
    "product_type": [
        "building", "sets", "vehicles", "minifigures", "accessories", "books", "comics",
    ],
}
UNKNOWN_CATEGORY = "Unknown"

# Single tags.
XMAS_WORDS = ["christmas", "xmas"]
OCCASION_WORDS = ["christmas", "birthday", "holiday", "everyday", "special", "treat"]

# Gold flags in table order: tag value -> tag columns that may hold it.
FLAG_SOURCES = {
    "action": ["play_type"],
    "star wars": ["franchise_type"],
    "special": ["occasion_type"],
    "minifigures": ["product_type"],
    "building": ["play_type", "theme_type"],
    "accessories": ["product_type"],
    "sets": ["product_type"],
    "animals": ["theme_type"],
    "holiday": ["occasion_type"],
    "kids": ["age_range"],
    "gift": ["occasion_type"],
    "advanced": ["skill_level"],
    "adventure": ["theme_type"],
    "disney": ["franchise_type"],
    "marvel": ["franchise_type"],
    "trucks": ["theme_type"],
    "vehicles": ["product_type"],
    "comics": ["product_type"],
    "strategy": ["play_type"],
    "construction": ["play_type"],
    "space": ["theme_type"],
    "christmas": ["occasion_type"],
    "everyday": ["occasion_type"],
    "adults": ["age_range"],
    "birthday": ["occasion_type"],
    "treat": ["occasion_type"],
    "harry potter": ["franchise_type"],
    "cars": ["theme_type"],
}

# Categories and allowed values offered to a tagging model.
MODEL_TAGS = {
    "Occasion": [
        "Christmas Gift", "Birthday Gift", "Holiday Gift", "Everyday Play", "Special Treat",
    ],
    "Age Range": ["Preschool", "Kids", "Teenagers", "Adults"],
    "Theme": ["Adventure", "Animals", "Cars and Trucks", "Fantasy", "Space", "Superheroes"],
    "Skill Level": ["Beginner", "Intermediate", "Advanced"],
    "Play Style": [
        "Building and Construction", "Imaginative Play", "Action and Adventure",
        "Strategy and Puzzle-Solving",
    ],
    "Franchise": ["Star Wars", "Harry Potter", "Marvel", "DC Comics", "Disney", "Pixar"],
    "Product Type": [
        "Building Sets", "Vehicles", "Minifigures", "Accessories", "Books and Comics",
    ],
}
MODEL_SETTINGS = {"temperature": 0.01, "max_tokens": 500}
MODEL_QUESTION = "Label this product:"
DESCRIPTION_SLOT = "{PRODUCT_DESCRIPTION}"
FLAG_KEYS = ["Occasion", "Age Range"]

# ---------------------------------------------------------------------------

MODEL_PROMPT = "\n".join(
    [
        f"You label products of a catalogue. Here is one description: {DESCRIPTION_SLOT}",
        "Label it in every category below, with the listed values only:",
        *(f"- {category}: ({', '.join(values)})" for category, values in MODEL_TAGS.items()),
        "Answer with one JSON object, category to list of values, and nothing else.",
        "Where the description does not say, answer [] for that category.",
    ]
)


def word_pattern(words: list[str], bounded: bool = False, fold_case: bool = True) -> str:
    """One capturing alternation over plain words.

    The look-ahead in front lists the letters that can come first, second and
    third. It changes no match; it lets the regex engine reject most positions
    by a table lookup instead of trying every word there.
    """
    if fold_case:
        words = [word.lower() for word in words]
    ahead = _ahead(words)
    plain = [_escaped(word, SIGNS) for word in words]
    if not bounded:
        return f"(?={ahead})({'|'.join(plain)})"
    # A word that begins or ends with a sign has no word boundary there.
    before, after = (all(re.match(r"\w", word[i]) for word in words) for i in (0, -1))
    if before and after:
        return rf"(?={ahead})\b({'|'.join(plain)})\b"
    edged = (
        (r"\b" if re.match(r"\w", word[0]) else "") + text + (r"\b" if re.match(r"\w", word[-1]) else "")
        for word, text in zip(words, plain)
    )
    return f"(?={ahead})({'|'.join(edged)})"


def one_pass(rules: dict[str, list[str]], bounded: bool = False) -> tuple[str, dict[str, dict[str, str]]] | None:
    """One pattern for the words of all tags, and per tag what a word found means to it.

    At each position the pattern takes the longest word in its group and moves on by one character,
    so words may overlap. Any other word that matches there is a beginning of that one; which of
    them is a tag's own first choice is known beforehand. None where that does not hold: for empty
    words, and with ``bounded`` for words that begin or end with a sign or are not ASCII.
    """
    words = sorted({word for some in rules.values() for word in some})
    plain = (word.isascii() and re.fullmatch(r"\w(.*\w)?", word) for word in words)
    if not words or not all(words) or bounded and not all(plain):
        return None
    meant: dict[str, dict[str, str]] = {tag: {} for tag in rules}
    for tag, some in rules.items():
        for word in words:
            first = next((w for w in some if _begins(word, w, bounded)), None)
            if first is not None:
                meant[tag][word] = first
    edge = r"\b" if bounded else ""
    return rf"(?={_ahead(words)}){edge}(?=({_longest_of(words)}){edge})", meant


def _begins(word: str, start: str, bounded: bool) -> bool:
    """Whether ``start`` matches where ``word`` does."""
    if not word.startswith(start) or word == start:
        return word == start
    return not bounded or not re.match(r"\w", word[len(start)])


def _longest_of(words: list[str]) -> str:
    """A pattern for the longest of some words: what they share at the beginning is tried once."""
    tails: dict[str, list[str]] = {}
    for word in words:
        if word:
            tails.setdefault(word[0], []).append(word[1:])
    branches = "|".join(_escaped(first, SIGNS) + _longest_of(rest) for first, rest in tails.items())
    if not tails or len(tails) == 1 and "" not in words:
        return branches
    return f"(?:{branches})" + ("?" if "" in words else "")


def _ahead(words: list[str]) -> str:
    """Classes of the letters that can come first, second and third."""
    width = min([3, *(len(word) for word in words)])
    letters = ("".join(sorted({word[i] for word in words})) for i in range(width))
    return "".join(f"[{_escaped(some, CLASS_SIGNS)}]" for some in letters)


SIGNS = r"\^$.|?*+()[]{}"
CLASS_SIGNS = r"\^-[]&"


def _escaped(text: str, signs: str) -> str:
    return "".join("\\" + c if c in signs else c for c in text)


def tag_patterns(
    rules: dict[str, list[str]], bounded: bool = False, fold_case: bool = True
) -> dict[str, str]:
    """Turn a rule set into column name -> pattern."""
    return {tag: word_pattern(words, bounded, fold_case) for tag, words in rules.items()}


def flag_name(value: str) -> str:
    return value.replace(" ", "_") + "_flag"

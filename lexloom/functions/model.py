"""Language model: the constants that the text and morphology operators are run with.

Every operator takes a model, so another language is another ``LanguageModel``; what
follows are the values of the default model.
"""

from __future__ import annotations

from dataclasses import dataclass, field


# Fixed values of the default model.
ALPHABET = "abcĉdefgĝhĥijĵklmnoprsŝtuŭvz"
ENDINGS = ("ajn", "ojn", "aj", "oj", "an", "on", "en", "as", "is", "os", "us", "a", "o", "e", "i", "u", "n", "j",)
PARTICIPLES = ("ant", "int", "ont", "at", "it", "ot",)
PREFIXES = ("mal", "ne", "ge", "bo", "ek", "el", "re", "dis", "for", "pra", "eks", "mis", "fi", "retro",)
PREPOSITION_PREFIXES = ("al", "antaŭ", "apud", "ĉe", "ĉirkaŭ", "de", "ekster", "en", "inter", "kontraŭ", "kun", "post", "preter", "pri", "sen", "sub", "super", "sur", "tra", "trans", "pli", "supren", "malsupren",)
SUFFIXES = ("estr", "ebl", "ind", "em", "ec", "aĵ", "ist", "an", "ul", "in", "id", "ig", "iĝ", "uj", "op", "obl", "on", "eg", "et", "ar", "er", "ej", "ad", "aĉ", "ĉj", "nj", "um", "end", "ism", "il",)
RARE_PREFIXES = ("fi", "bo", "eks", "mis", "pra", "retro",)
CLOSED_CLASS = (
    "la", "kaj", "aŭ", "ke", "ĉu", "se", "ĉar", "ol", "nek", "do", "sed", "ne", "jes", "ja", "ankaŭ", "eĉ", "nur", "jam", "ankoraŭ", "plu", "tre", "tro", "pli", "plej", "tuj", "nun", "hodiaŭ", "hieraŭ", "morgaŭ", "baldaŭ", "mi",
    "vi", "li", "ŝi", "ĝi", "ni", "ili", "si", "oni", "ci", "al", "apud", "ĉe", "ĉirkaŭ", "da", "de", "dum", "el", "en", "ekster", "ĝis", "inter", "je", "kontraŭ", "krom", "kun", "per", "po", "por", "post", "preter", "pri", "pro",
    "sen", "sub", "super", "sur", "tra", "trans", "anstataŭ", "antaŭ", "malgraŭ", "kvazaŭ", "laŭ", "pere", "unu", "du", "tri", "kvar", "kvin", "ses", "sep", "ok", "naŭ", "dek", "cent", "mil", "nulo",
)
NON_DERIVING = ("kaj", "aŭ", "ke", "ĉu", "se", "ĉar", "ol", "nek", "do", "sed", "jes", "ja", "ankaŭ", "eĉ", "nur",)
CORRELATIVE = r"^(ki|ti|i|ĉi|neni)(u|o|a|e|am|al|el|om|es)(j?n?)$"
NUMERALS = ("unu", "du", "tri", "kvar", "kvin", "ses", "sep", "ok", "naŭ", "dek", "cent", "mil",)
STOPWORDS = ("l", "ktp", "ekz", "prof", "kop", "esp", "fr", "np", "ex", "zool", "ĥem", "med", "geom", "fiz", "bot", "anat", "mat", "haml", "kos", "no", "nro", "vol", "pĝ", "red", "ks",)
DOUBLE_PREFIX_OK = ("mal", "ne",)
NEVER_ROOT = ("ig", "iĝ",)
#: Sort key: the alphabet's letters in their order, anything else behind them.
COLLATION_KEY = "ABCDEFGHIJKLMNOPQRSTUVWXYZ[]"


@dataclass(frozen=True)
class LanguageModel:
    alphabet: str = ALPHABET
    endings: tuple[str, ...] = ENDINGS
    participles: tuple[str, ...] = PARTICIPLES
    prefixes: tuple[str, ...] = PREFIXES
    preposition_prefixes: tuple[str, ...] = PREPOSITION_PREFIXES
    suffixes: tuple[str, ...] = SUFFIXES
    rare_prefixes: frozenset[str] = frozenset(RARE_PREFIXES)
    closed_class: frozenset[str] = frozenset(CLOSED_CLASS)
    non_deriving: frozenset[str] = frozenset(NON_DERIVING)
    correlative: str = CORRELATIVE
    numerals: tuple[str, ...] = NUMERALS
    stopwords: frozenset[str] = frozenset(STOPWORDS)
    extra_letters: str = "qwxy"
    no_split: frozenset[str] = frozenset()
    overrides: dict[str, tuple] = field(default_factory=dict, hash=False)

    @property
    def affix_roots(self) -> frozenset[str]:
        """Affixes that may also be read as roots."""
        return frozenset(self.prefixes + self.suffixes + self.participles)

    @property
    def token_pattern(self) -> str:
        letters = "".join(c for c in self.alphabet if not c.isascii())
        return f"[a-zA-Z{letters}{letters.upper()}']+"


DEFAULT = LanguageModel()

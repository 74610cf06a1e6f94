"""Wiki markup and mail to text, as functions over one text and as pandas UDFs."""

from __future__ import annotations

import email
import email.policy
import email.utils
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from email.header import decode_header, make_header
from itertools import groupby

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Headings whose section is dropped, templates by what they keep, formatting arguments, link
# prefixes of files and categories, what opens and closes a construct.
DROPPED_SECTIONS = frozenset(["referencoj", "fontoj", "notoj", "eksteraj ligiloj", "vidu ankaŭ", "bibliografio", "literaturo", "piednoto", "piednotoj", "fontnotoj", "rilataj artikoloj", "ekstera ligilo", "plia legado"])
DROPPED_TEMPLATES = frozenset(["rh", "runningheader", "tab", "---", "nop", "pagequality", "reflist", "ppoem-close"])
LAST_ARGUMENT = frozenset(["lang", "sic", "vde", "vdk", "vdf"])
FORMATTING = re.compile(r"(?:\d+(?:px|%|em)?|[clrjm]|left|right|center|small|big)", re.I)
ARTICLE_FILES = frozenset(["kategorio", "dosiero", "file", "image"])
BOOK_FILES = frozenset(["file", "image", "dosiero", "bildo"])
CLOSES = {"{{": "}}", "{|": "|}", "[[": "]]"}
_MARK = re.compile(r"\{\{|\}\}|\{\||\|\}(?!\})|\[\[|\]\]")
_HEADING = re.compile(r"^(={2,6})\s*(.+?)\s*\1\s*$", re.M)
_OUTSIDE = re.compile(r"\[(?:https?:|//)\S+ ([^\]]*)\]")


def resolved(text: str, show: Callable[[str, str], str]) -> str:
    """Templates, tables and links, nested in each other to any depth, each replaced by ``show(opener, inside)``, the
    inner ones first. What is never closed, or closed without having been opened, stays as it is written."""
    stack: list[tuple[str, list[str]]] = [("", [])]
    open_: Counter[str] = Counter()

    def close(count: int) -> None:
        for _ in range(count):  # never closed: text of what lies around it
            opener, pieces = stack.pop()
            open_[CLOSES[opener]] -= 1
            stack[-1][1].append(opener + "".join(pieces))

    at = 0
    for m in _MARK.finditer(text):
        stack[-1][1].append(text[at : m.start()])
        at, sign = m.end(), m[0]
        if sign in CLOSES:
            stack.append((sign, []))
            open_[CLOSES[sign]] += 1
            continue
        if not open_[sign]:
            stack[-1][1].append(sign)
            continue
        close(next(i for i, (opener, _) in enumerate(reversed(stack)) if CLOSES[opener] == sign))
        opener, pieces = stack.pop()
        open_[sign] -= 1
        stack[-1][1].append(show(opener, "".join(pieces)))
    stack[-1][1].append(text[at:])
    close(len(stack) - 1)
    return "".join(stack[0][1])


def template_text(inside: str) -> str:
    """What a template leaves in the text: nothing, its last argument, or the first that isn't formatting."""
    name, *args = (x.strip() for x in inside.split("|"))
    said = [x for x in args if x and "=" not in x and not FORMATTING.fullmatch(x)]
    return "" if name.lower() in DROPPED_TEMPLATES or not said else said[-1 if name.lower() in LAST_ARGUMENT else 0]


def link_text(inside: str, files: frozenset[str]) -> str:
    """A link's label, or its target; nothing for files and categories."""
    target, bar, label = inside.partition("|")
    return "" if target.partition(":")[0].strip().lower() in files and ":" in target else label if bar else target


def without_sections(text: str, dropped: frozenset[str] = DROPPED_SECTIONS) -> str:
    """Sections under a dropped heading go, with all deeper ones in them."""
    parts = _HEADING.split(text)  # text, level and heading and text, ...
    kept, gone = [parts[0]], 7
    for level, heading, body in zip(parts[1::3], parts[2::3], parts[3::3], strict=True):
        if len(level) <= gone:
            gone = len(level) if heading.split("[")[0].strip().lower() in dropped else 7
        if gone == 7:
            kept.append(f"{level} {heading} {level}{body}")
    return "".join(kept)


def prose(wikitext: str | None) -> str | None:
    """An article as one paragraph of prose, without its templates, tables, lists and notes; None for a redirect."""
    if wikitext is None or re.match(r"\s*#(?:REDIRECT|ALIDIREKTI)", wikitext, re.I):
        return None
    text = re.sub(r"(?s)<!--.*?-->|<ref[^>]*?/>|<ref[^>]*?>.*?</ref>|<gallery[^>]*?>.*?</gallery>", "", wikitext)
    text = resolved(without_sections(text), lambda opener, inside: link_text(inside, ARTICLE_FILES) if opener == "[[" else "")
    text = re.sub(r"(?s)<(table|references|nowiki)[^>]*>.*?</\1>", "", text)
    lines = (line for line in _HEADING.sub("", text).split("\n") if not line.lstrip().startswith(("|", "!", "*", "#", ":", ";")))
    text = re.sub(r"<[^>]+>|'{2,5}|\[https?:\S+\]", "", _OUTSIDE.sub(r"\1", "\n".join(lines)))
    text = re.sub(r"\(\s*\)|\[\s*\]|\{\{|\}\}", " ", " ".join(text.split()))
    front = re.match(r"[\s)\]}.,;:!?\-–—„\"'«0-9]{0,14}(?![\s)\]}.,;:!?\-–—„\"'«0-9])", text)
    return text[front.end() if front else 0 :].strip()


def book_text(wikitext: str | None) -> str:
    """A book's joined pages as text with its lines kept, templates by what they show."""
    text = re.sub(r"(?is)<!--.*?-->|<ref[^>]*/>|<ref[^>]*>.*?</ref>", "", wikitext or "")
    shown = {"{{": template_text, "{|": lambda _: "", "[[": lambda inside: link_text(inside, BOOK_FILES)}
    text = resolved(text, lambda opener, inside: shown[opener](inside))
    text = re.sub(r"<[^>]+>|'{2,5}", "", _OUTSIDE.sub(r"\1", text))
    return "\n".join(_joined(map(_book_line, text.split("\n")))).strip()


def _book_line(line: str) -> str:
    """A heading without its signs, nothing for a page number, a list's line without its marks."""
    heading = re.fullmatch(r"\s*=+\s*(.*?)\s*=+\s*", line)
    line = heading[1] if heading else line
    return "" if re.fullmatch(r"\s*\d{1,4}\s*", line) else re.sub(r"^[*#:;]+\s*", "", line)


def _joined(lines: Iterable[str]) -> Iterator[str]:
    """Lines, of empty ones never two in a row."""
    return (line for empty, group in groupby(lines, lambda x: x == "") for line in ([""] if empty else group))


def decoded(payload: bytes, charset: str | None) -> str:
    """By the declared charset, else the first of the usual ones that fits."""
    for name in (charset, "utf-8", "iso-8859-3", "iso-8859-1", "cp1252"):
        try:
            if name:
                return payload.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return payload.decode("utf-8", "replace")


def text_part(message: email.message.Message) -> str:
    """The first plain text part that is no attachment."""
    for part in message.walk():
        if part.get_content_type() == "text/plain" and not part.get_filename():
            return decoded(part.get_payload(decode=True) or b"", part.get_content_charset())
    return ""


# Kinds of lines of a message's body.
LINE_KINDS = {"armour": r"begin [0-7]{3} |-----BEGIN ", "signature": r"--\s*$", "quote": r"\s*[>|]", "short": r"\s*\S?\s*$"}
_LINE_KINDS = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern in LINE_KINDS.items()))


def mail_body(body: str | None) -> str:
    """A body without quotes, signature, encoded blocks (up to a blank line) and one-character lines, on one line."""
    said, armoured = [], False
    for line in (body or "").splitlines():
        kind = (m := _LINE_KINDS.match(line)) and m.lastgroup
        armoured = kind == "armour" or (armoured and line.strip() != "")
        if kind == "signature" and not armoured:
            break
        if kind is None and not armoured:
            said.append(line.strip())
    return " ".join(said)


def header_fields(raw: bytes) -> tuple[str, str, str, str, str]:
    """msgid, author, subject, date (YYYY-MM-DD or empty) and body of a raw message."""
    message = email.message_from_bytes(raw, policy=email.policy.compat32)
    flat = lambda v: re.sub(r"[\t\n\r]+", " ", str(make_header(decode_header(v))) if v else "").strip()
    try:
        day = email.utils.parsedate_to_datetime(message.get("date")).strftime("%Y-%m-%d")
    except (TypeError, ValueError):
        day = ""
    name, address = email.utils.parseaddr(flat(message.get("from")))
    return flat(message.get("message-id")), name or address.split("@")[0], flat(message.get("subject")), day, mail_body(text_part(message))


class Mbox(DataSource):
    """Messages of mail folders: ``spark.read.format("mbox").load(path)``, one task a file."""

    @classmethod
    def name(cls) -> str:
        return "mbox"

    def schema(self) -> str:
        return "file string, number long, msgid string, author string, subject string, date string, text string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _MboxReader(self.options["path"])


#: A strict envelope line, with or without a comma behind the day: anything less is a line of text that happens to
#: start with From.
_MONTH = rb"(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
ENVELOPE = re.compile(rb"^From \S{1,64} +(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun),? +(?:\d{1,2} +" + _MONTH + rb"|" + _MONTH + rb" +\d{1,2}).*\d{4}.*\r?\n", re.M)


def split_mbox(data: bytes) -> Iterator[bytes]:
    marks = list(ENVELOPE.finditer(data))
    for m, end in zip(marks, [*(x.start() for x in marks[1:]), len(data)], strict=False):
        yield data[m.end() : end]


class _MboxReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        import pyarrow.fs as pafs

        store, root = pafs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("/") else f"/{self.path}")
        info = store.get_file_info(root)
        files = [info.path] if info.type == pafs.FileType.File else [f.path for f in store.get_file_info(pafs.FileSelector(root)) if f.type == pafs.FileType.File and not f.base_name.startswith((".", "_"))]
        return [InputPartition(f) for f in sorted(files)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import pyarrow.fs as pafs

        store, _ = pafs.FileSystem.from_uri(self.path)
        with store.open_input_file(partition.value) as f:
            for i, raw in enumerate(split_mbox(f.read())):
                yield (partition.value.rsplit("/", 1)[-1], i, *header_fields(raw))


@F.pandas_udf(StringType())
def wiki_prose(text: pd.Series) -> pd.Series:
    return text.map(prose)


@F.pandas_udf(StringType())
def wiki_book(text: pd.Series) -> pd.Series:
    return text.map(book_text)


@F.pandas_udf(StringType())
def clean_mail(text: pd.Series) -> pd.Series:
    return text.map(mail_body)

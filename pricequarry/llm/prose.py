"""Running prose of a wiki page: what is left outside markup, tables, templates, references and comments."""

from __future__ import annotations

import html
import re

COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
DROPPED_TAGS = re.compile(r"<(ref|gallery|math|timeline|pre|code|syntaxhighlight|source|score|imagemap)\b(?:[^<>]*/>|[^<>]*>.*?(?:</\1\s*>|\Z))", re.S | re.I)
TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
NOWIKI = re.compile(r"<nowiki>.*?(?:</nowiki>|\Z)", re.S | re.I)
OPENING = re.compile(r"\{\{|\}\}|\{\||\|\}")
PLAIN_TEMPLATE = re.compile(r"\{\{\s*(?:nowrap|lang\s*\|\s*[\w-]+|small|abbr|em|strong|nobr)\s*\|([^{}|]*)[^{}]*\}\}", re.I)
FILE_LINK = re.compile(r"\[\[\s*(?:file|image|category|datei|kategorie|fichier|archivo)\s*:[^\[\]]*(?:\[\[[^\[\]]*\]\][^\[\]]*)*\]\]", re.I)
LINK = re.compile(r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]")
EXTERNAL = re.compile(r"\[(?:https?:)?//[^\s\]]+\s*([^\]]*)\]|https?://\S+")
QUOTES = re.compile(r"'{2,}")
LINES = re.compile(r"^(?:=+.*=+|[*#:;|!].*|-{4,}|__\w+__|#redirect.*)\s*$", re.I | re.M)
WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|\d+(?:[.,]\d+)*")
SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n\s*\n")


def outside_braces(text: str) -> str:
    """The text outside {{templates}} and {|tables|}, however nested; an opening that is never closed takes its line."""
    if "{{" not in text and "{|" not in text:
        return text
    out: list[str] = []
    open_at: list[tuple[str, int]] = []
    at = 0
    for m in OPENING.finditer(text):
        mark = m.group()
        if mark in ("{{", "{|"):
            if not open_at:
                out.append(text[at : m.start()])
            open_at.append((mark, m.start()))
        elif open_at and open_at[-1][0] == ("{{" if mark == "}}" else "{|"):
            open_at.pop()
            if not open_at:
                at = m.end()
                out.append(" ")
    if open_at:
        start = open_at[0][1]
        end = text.find("\n", start)
        out.append("" if end < 0 else outside_braces(text[end:]))
    else:
        out.append(text[at:])
    return "".join(out)


def prose(text: str | None) -> str:
    if not text or text.lstrip()[:9].lower().replace(" ", "") in ("#redirect",):
        return ""
    if "<" in text:
        text = NOWIKI.sub(" ", DROPPED_TAGS.sub(" ", COMMENT.sub(" ", text)))
    if "{" in text:
        text = outside_braces(PLAIN_TEMPLATE.sub(r"\1", text))
    if "[" in text:
        text = EXTERNAL.sub(r"\1", LINK.sub(r"\1", FILE_LINK.sub(" ", text)))
    text = QUOTES.sub("", TAG.sub(" ", text))
    if "&" in text:
        text = html.unescape(text)
    return LINES.sub("\n\n", text.replace("­", ""))


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence of prose."""
    return [ws for s in SENTENCE.split(text) if (ws := WORD.findall(s))]

"""The shape of a statement: its text without what differs between runs of the same statement.

A lexer in one pattern cuts the text into strings, comments, quoted names, numbers and runs of words and single signs, so
that what is done in Spark is per piece and not per word. Comments go, strings and numbers become ``?``, the words and
signs of runs are set apart and lower-cased, a list after IN becomes ``( ? )`` whatever its length, and all
is joined by single spaces. Statements that differ in literals, comments or layout so have one shape, and its hash is
their identity in a log. A quote inside a comment opens no string, and a comment mark inside a string or a quoted name
no comment. Block comments nest up to ``NESTED`` deep; marks of deeper ones are signs. What is not closed ends with the text.

All loops of the pattern are possessive: a text is read once, whatever it holds, and long ones need no stack.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NESTED = 8


def _block_comment(depth: int) -> str:
    inner = rf"|{_block_comment(depth - 1)}" if depth > 1 else ""
    return rf"/\*(?:(?!/\*|\*/)[\s\S]{inner})*+(?:\*/|\z)"


STRING = r"[nN]?'[^']*+(?:''[^']*+)*+(?:'|\z)"
COMMENT = rf"--[^\r\n]*+|{_block_comment(NESTED)}"
NAME = r'"[^"]*+(?:""[^"]*+)*+(?:"|\z)|\[[^\]]*+(?:\]\][^\]]*+)*+(?:\]|\z)'
WORD = r"[\p{L}_@#$][\p{L}\p{N}_@#$]*+"
NUMBER = r"0[xX][0-9A-Fa-f]*+|(?:[0-9]++(?:\.[0-9]*+)?+|\.[0-9]++)(?:[eE][+-]?[0-9]++)?+"
OTHER = rf"[^\s\p{{L}}_@#$'\"\[0-9./-]|\.(?![0-9])|-(?!-)|/(?!\*)|(?!{_block_comment(NESTED)})/"
# What stays but for its case and layout: words and single signs up to the next literal, comment or quoted name.
RUN = rf"(?:\s|(?![nN]'){WORD}|{OTHER})++"
PIECE = rf"({STRING}|{NAME}|{NUMBER}|{RUN})|{COMMENT}"
SPACED = rf"\s*+({WORD}|\S|\z)"
IN_LIST = r"(?<![^ ])in \( (?:[-+] )?\?(?: , (?:[-+] )?\?)*+ \)"


def statement_shape(text: Column) -> Column:
    """The shape of a statement's text; null for a null text."""

    def placed(piece: Column) -> Column:
        first, second = F.left(piece, F.lit(1)), F.substring(piece, 2, 1)
        literal = first.between("0", "9") | (first == "'") | (first.isin("n", "N") & (second == "'")) | (
            (first == ".") & second.between("0", "9")
        )
        # Lower case comes last: it may turn a letter into a letter and a mark.
        run = F.trim(F.lower(F.regexp_replace(piece, SPACED, " $1")))
        return F.when(first.isin('"', "["), piece).when(literal, F.lit("?")).otherwise(run)

    # A comment is a match without the group, which is an empty piece.
    pieces = F.filter(F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(1)), placed), lambda p: p != "")
    return F.regexp_replace(F.array_join(pieces, " "), IN_LIST, "in ( ? )")


def statement_hash(text: Column) -> Column:
    """The identity of a statement: 32 hex digits of its shape's hash."""
    return F.substring(F.sha2(statement_shape(text), 256), 1, 32)

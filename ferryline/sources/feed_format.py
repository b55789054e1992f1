"""How a delimited feed is spelled."""

from __future__ import annotations

from dataclasses import dataclass

BYTE_ORDER_MARK = "\ufeff"


@dataclass(frozen=True)
class FeedFormat:
    """Options of a delimited text feed, the same for writing and reading.

    Unquoted form (default): the delimiter, the escape character, CR and LF inside
    a value get the escape character in front. Records end with CRLF, which an
    escaped value cannot contain, so such a feed splits safely into tasks.

    Quoted form: a value is quoted only if it holds the delimiter, ``"``, CR or LF.
    Its values may hold raw line ends, so one file is one task on reading.

    ``escape=""`` switches escaping off; a value that needs it stops the export.

    The NULL marker is written as it is, so it reads back as NULL.
    ``legacy_null_escape`` escapes it like a value (``\\N`` leaves as ``\\\\N``);
    on reading such a marker is then recognised in its escaped spelling.

    ``single_line`` promises that no value holds an LF. Only with it may records of an escaped
    feed end with LF, as most text feeds do. A value with an LF stops the export, and a record that
    ends within an escape, as an LF did stand in a value, is malformed.
    """

    delimiter: str = "`"
    escape: str = "\\"
    null_marker: str = ""
    quote: bool = False
    header: bool = True
    bom: bool = False
    line_sep: str = "\r\n"
    legacy_null_escape: bool = False
    single_line: bool = False

    def __post_init__(self) -> None:
        if len(self.delimiter) != 1 or self.delimiter in "\r\n":
            raise ValueError("the delimiter is one character, not a line end")
        if len(self.escape) > 1 or self.escape in ("\r", "\n", self.delimiter):
            raise ValueError("the escape is one other character or empty")
        if self.quote and self.delimiter == '"':
            raise ValueError("a quoted feed cannot use the quote as delimiter")
        if self.line_sep not in ("\r\n", "\n"):
            raise ValueError("records end with CRLF or LF")
        if not self.quote and self.line_sep == "\n" and self.escape and not self.single_line:
            raise ValueError(
                "an escaped LF would end the record: use CRLF, or single_line=True if no value holds one"
            )
        if any(c in self.null_marker for c in (self.delimiter, "\r", "\n")):
            raise ValueError("the NULL marker cannot hold the delimiter or a line end")

    @property
    def specials(self) -> tuple[str, ...]:
        """Characters an unquoted value cannot hold as they are; the escape comes first."""
        return ((self.escape,) if self.escape else ()) + (self.delimiter, "\r", "\n")

    @property
    def written_null(self) -> str:
        if self.legacy_null_escape and self.escape and not self.quote:
            return self.null_marker.replace(self.escape, self.escape * 2)
        return self.null_marker

    def header_cell(self, name: str) -> str:
        """A column name in the spelling of a value (driver side, once per export)."""
        if self.quote:
            if any(c in name for c in (self.delimiter, '"', "\r", "\n")):
                return '"' + name.replace('"', '""') + '"'
            return name
        if not self.escape and any(c in name for c in self.specials):
            raise ValueError(f"column name {name!r} needs an escape character")
        if self.single_line and "\n" in name:
            raise ValueError(f"column name {name!r} holds an LF")
        for special in self.specials:
            name = name.replace(special, self.escape + special)
        return name

    def header_line(self, names: list[str]) -> str:
        return self.delimiter.join(self.header_cell(n) for n in names)


# The feed that table loads expect.
LOAD_FORMAT = FeedFormat(delimiter="\t", null_marker="\\N", header=False)

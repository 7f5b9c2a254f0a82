"""Named file formats: how a CSV file set is cut into fields and typed."""

from __future__ import annotations

from dataclasses import dataclass, replace

from millrace.functions.parse import AUTO

SLASH_DATE, SLASH_STAMP = "yyyy/MM/dd", "yyyy/MM/dd HH:mm:ss"


@dataclass(frozen=True)
class CsvFormat:
    """Parse options of one file format.

    ``multi_line`` expects line breaks inside quoted fields in every file; without it, they
    are looked for in files that have a line with an odd number of quotes. A record of more
    than ``most_record_bytes`` is in error, as one that a stray quote opened.
    """

    delimiter: str = ","
    record_delimiter: str | None = None  # unset: any of LF, CR, CRLF
    skip_header: int = 0
    quote: str | None = None
    null_if: tuple[str, ...] = ("\\N",)
    empty_as_null: bool = True
    trim: bool = False
    encoding: str = "UTF-8"
    date_format: str = AUTO  # recognised by the text itself
    timestamp_format: str = AUTO  # times of day go with it
    strict_columns: bool = True
    strict_encoding: bool = True
    skip_blank_lines: bool = False
    skip_byte_order_mark: bool = True
    multi_line: bool = False
    most_record_bytes: int = 16 << 20

    def with_options(self, **changes) -> "CsvFormat":
        return replace(self, **changes)


# --- fixed values: the formats files are delivered in ------------------------------------
STAGE_DEFAULT = CsvFormat()
FORMATS = {
    "FF_CSV_COMMON": CsvFormat(
        skip_header=1,
        quote='"',
        null_if=("", "NULL"),
        trim=True,
        encoding="SHIFT_JIS",
        date_format=SLASH_DATE,
        timestamp_format=SLASH_STAMP,
    ),
    "FF_CSV_PROD_LOG_FH": CsvFormat(
        skip_header=1,
        quote='"',
        null_if=("", "NULL"),
        trim=True,
        encoding="SHIFT_JIS",
        date_format=SLASH_DATE,
        timestamp_format=SLASH_STAMP,
        strict_columns=False,
    ),
    "MST_CSV_FORMAT": CsvFormat(skip_header=1, quote='"', null_if=("", "NULL")),
    "MYFORMAT": CsvFormat(skip_header=1, quote='"'),
}

# Shift_JIS files hold vendor characters and half-width kana; this superset reads them all.
_CHARSETS = {"SHIFT_JIS": "windows-31j", "SJIS": "windows-31j", "UTF8": "UTF-8"}


def charset(encoding: str) -> str:
    return _CHARSETS.get(encoding.upper(), encoding)


def named(name: str) -> CsvFormat:
    """Format by name; a database and schema prefix is allowed."""
    try:
        return FORMATS[name.split(".")[-1].upper()]
    except KeyError:
        raise KeyError(f"unknown file format {name!r}") from None

"""Per-file ``.xlsx`` decoding helpers (standard library only).

Used inside ``mapInPandas`` tasks: one workbook is one zip archive and cannot
be split, so each task decodes whole workbooks and yields their rows in
bounded batches.  Cells are rendered as text: strings as stored, numbers in
shortest form, date-styled numbers as ``YYYY-MM-DD HH:MM:SS``.
"""

from __future__ import annotations

import datetime as _dt
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree as ET

NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PKG_REL_NS = "{http://schemas.openxmlformats.org/package/2006/relationships}"

# Built-in number formats that display dates or times.
BUILTIN_DATE_FORMATS = frozenset(list(range(14, 23)) + list(range(27, 37)) + list(range(45, 48))
                                 + list(range(50, 59)))
EPOCH_1900 = _dt.datetime(1899, 12, 30)
EPOCH_1904 = _dt.datetime(1904, 1, 1)
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")


class WorkbookError(ValueError):
    pass


def column_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _is_date_format(code: str) -> bool:
    code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code.lower())
    return bool(re.search(r"[dmyhs]", code)) and "general" not in code


def render_number(v: float) -> str:
    if v.is_integer() and abs(v) < 1e16:
        return str(int(v))
    return repr(v)


def render_datetime(serial: float, date1904: bool = False) -> str:
    base = EPOCH_1904 if date1904 else EPOCH_1900
    ms = round(serial * 86_400_000)
    t = base + _dt.timedelta(milliseconds=ms)
    s = f"{t.year:04d}-{t.month:02d}-{t.day:02d} {t.hour:02d}:{t.minute:02d}:{t.second:02d}"
    return s + (f".{t.microsecond:06d}".rstrip("0") if t.microsecond else "")


class Workbook:
    def __init__(self, content: bytes):
        try:
            self.zf = zipfile.ZipFile(io.BytesIO(content))
        except zipfile.BadZipFile as e:
            raise WorkbookError("not an .xlsx workbook (zip archive expected)") from e
        self.names = set(self.zf.namelist())
        self.shared = self._shared_strings()
        self.date_styles, self.date1904 = self._styles()

    def _xml(self, name: str):
        return ET.fromstring(self.zf.read(name))

    def _shared_strings(self) -> list[str]:
        name = "xl/sharedStrings.xml"
        if name not in self.names:
            return []
        out = []
        for si in self._xml(name).iter(f"{NS}si"):
            parts = [t.text or "" for t in si.iter(f"{NS}t")
                     if not any(t in rph.iter(f"{NS}t") for rph in si.iter(f"{NS}rPh"))]
            out.append("".join(parts))
        return out

    def _styles(self) -> tuple[list[bool], bool]:
        date1904 = False
        wb = self._xml("xl/workbook.xml")
        pr = wb.find(f"{NS}workbookPr")
        if pr is not None and pr.get("date1904") in ("1", "true"):
            date1904 = True
        name = "xl/styles.xml"
        if name not in self.names:
            return [], date1904
        st = self._xml(name)
        custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in st.iter(f"{NS}numFmt")}
        xfs = st.find(f"{NS}cellXfs")
        flags = []
        for xf in (xfs if xfs is not None else []):
            fid = int(xf.get("numFmtId", "0"))
            flags.append(fid in BUILTIN_DATE_FORMATS or (fid in custom and _is_date_format(custom[fid])))
        return flags, date1904

    def sheets(self) -> list[tuple[str, str]]:
        """(sheet name, part path) in workbook order."""
        wb = self._xml("xl/workbook.xml")
        rels = self._xml("xl/_rels/workbook.xml.rels")
        target = {r.get("Id"): r.get("Target") for r in rels.iter(f"{PKG_REL_NS}Relationship")}
        out = []
        for s in wb.iter(f"{NS}sheet"):
            t = target[s.get(f"{REL_NS}id")]
            path = t.lstrip("/") if t.startswith("/") else posixpath.normpath(posixpath.join("xl", t))
            out.append((s.get("name"), path))
        return out

    def _cell_text(self, c) -> str | None:
        t = c.get("t", "n")
        if t == "inlineStr":
            is_ = c.find(f"{NS}is")
            return None if is_ is None else "".join(x.text or "" for x in is_.iter(f"{NS}t"))
        v = c.find(f"{NS}v")
        if v is None or v.text is None:
            return None
        raw = v.text
        if t == "s":
            return self.shared[int(raw)]
        if t in ("str", "e"):
            return raw
        if t == "b":
            return "true" if raw.strip() == "1" else "false"
        num = float(raw)
        s = int(c.get("s", "0"))
        if s < len(self.date_styles) and self.date_styles[s]:
            return render_datetime(num, self.date1904)
        return render_number(num)

    def rows(self, path: str) -> Iterator[tuple[int, dict[int, str]]]:
        """(row number, {column index: text}) for every row element of a sheet."""
        with self.zf.open(path) as fh:
            for _, el in ET.iterparse(fh, events=("end",)):
                if el.tag != f"{NS}row":
                    continue
                cells = {}
                auto_col = 0
                for c in el.iter(f"{NS}c"):
                    ref = c.get("r")
                    if ref:
                        m = _CELL_REF.match(ref)
                        col = column_index(m.group(1))
                    else:
                        col = auto_col
                    auto_col = col + 1
                    text = self._cell_text(c)
                    if text is not None:
                        cells[col] = text
                yield int(el.get("r")), cells
                el.clear()


def sheet_records_reference(book: Workbook, path: str, positions: Sequence[int]
                            ) -> Iterator[tuple[int, list[str | None]]]:
    """Straightforward (element tree, whole sheet in memory) version of
    ``sheet_records``; kept as the brute-force check for the streaming one."""
    rows = [(r, cells) for r, cells in book.rows(path) if cells]
    if not rows:
        return
    first_row = rows[0][0]
    first_col = min(min(cells) for _, cells in rows)
    width = max(max(cells) for _, cells in rows) - first_col + 1
    if positions and max(positions) >= width:
        raise WorkbookError(f"wrong number of columns: {width}; needed: {max(positions) + 1}")
    expected = first_row + 1
    for r, cells in rows[1:]:
        while expected < r:
            yield expected, [None] * len(positions)
            expected += 1
        yield r, [cells.get(first_col + p) for p in positions]
        expected = r + 1


# Streaming decoder: the sheet part is read in chunks of whole <row> elements,
# twice: once to find the used range (first/last row and column holding a
# value), once to render only the requested cells.  Memory stays bounded by
# one chunk, whatever the sheet size.
_P = rb"(?:[A-Za-z_][\w.-]*:)?"
_ROW = re.compile(rb"<" + _P + rb"row\b([^>]*?)(?:/>|>(.*?)</" + _P + rb"row>)", re.S)
# a cell: (column letters, attributes, body); cells without r="" get letters b""
_CELL = re.compile(rb"<" + _P + rb"c\b(?=(?:[^>]*?\br=\"([A-Z]+)\d+\")?)([^>]*?)(?:/>|>(.*?)</" + _P + rb"c>)", re.S)
# cells holding a value: (column letters, row number)
_VALUED = re.compile(rb"<" + _P + rb"c\b[^>]*?\br=\"([A-Z]+)(\d+)\"[^>]*?(?<!/)>\s*(?:<" + _P + rb"f\b[^>]*?(?:/>|>.*?</"
                     + _P + rb"f>)\s*)?<" + _P + rb"(?:v|is)\b", re.S)
_VALUED_PLAIN = re.compile(rb'<c r="([A-Z]+)([0-9]+)"[^>]*?(?<!/)>\s*(?:<f>[^<]*</f>\s*|<f [^>]*?/>\s*|<f [^>]*>[^<]*</f>\s*)?<(?:v|is)[ >]')
_ROW_END = re.compile(rb"</" + _P + rb"row>")
_A_ROWNUM = re.compile(rb'\br="(\d+)"')
_A_T = re.compile(rb'\bt="(\w+)"')
_A_S = re.compile(rb'\bs="(\d+)"')
_V = re.compile(rb"<" + _P + rb"v(?:\s[^>]*)?>(.*?)</" + _P + rb"v>", re.S)
_T = re.compile(rb"<" + _P + rb"t(?:\s[^>]*)?>(.*?)</" + _P + rb"t>", re.S)
_RPH = re.compile(rb"<" + _P + rb"rPh\b.*?</" + _P + rb"rPh>", re.S)
_ENTITY = re.compile(r"&(#x[0-9A-Fa-f]+|#[0-9]+|amp|lt|gt|quot|apos);")
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
CHUNK = 1 << 22


def _unescape(text: str) -> str:
    if "&" not in text:
        return text

    def rep(m):
        e = m.group(1)
        if e[0] == "#":
            return chr(int(e[2:], 16) if e[1] in "xX" else int(e[1:]))
        return _NAMED[e]
    return _ENTITY.sub(rep, text)


def _row_chunks(book: Workbook, path: str) -> Iterator[bytes]:
    """The sheet part in pieces that end on a complete row element."""
    with book.zf.open(path) as fh:
        rest = b""
        while True:
            data = fh.read(CHUNK)
            buf = rest + data
            if not data:
                if buf:
                    yield buf
                return
            last = None
            for last in _ROW_END.finditer(buf):
                pass
            if last is None:
                rest = buf
                continue
            yield buf[:last.end()]
            rest = buf[last.end():]


def _attr(attrs: bytes, key: bytes, pattern) -> bytes | None:
    """Attribute value; fast path for the usual `` key="..."`` spelling."""
    i = attrs.find(key)
    if i >= 0:
        j = i + len(key)
        return attrs[j:attrs.index(b'"', j)]
    m = pattern.search(attrs)
    return m.group(1) if m else None


def _cell_value(book: Workbook, attrs: bytes, inner: bytes) -> str | None:
    kind = _attr(attrs, b' t="', _A_T) or b"n"
    if kind == b"inlineStr":
        body = _RPH.sub(b"", inner)
        parts = _T.findall(body)
        return _unescape(b"".join(parts).decode("utf-8")) if parts or b"is" in inner else None
    if inner.startswith(b"<v>") and inner.endswith(b"</v>"):
        raw_b = inner[3:-4]
    else:
        v = _V.search(inner)
        if v is None:
            return None
        raw_b = v.group(1)
    if kind == b"s":
        return book.shared[int(raw_b)]
    raw = _unescape(raw_b.decode("utf-8"))
    if kind in (b"str", b"e"):
        return raw
    if kind == b"b":
        return "true" if raw.strip() == "1" else "false"
    if raw == "":
        return None
    num = float(raw)
    si = _attr(attrs, b' s="', _A_S)
    si = int(si) if si else 0
    if si < len(book.date_styles) and book.date_styles[si]:
        return render_datetime(num, book.date1904)
    return render_number(num)


def _used_range(book: Workbook, path: str) -> tuple[int, int, int, int] | None:
    """(first row, last row, first column, last column) of cells holding a value."""
    r0 = r1 = None
    letters: set[bytes] = set()
    for chunk in _row_chunks(book, path):
        plain = b":c " not in chunk and chunk.count(b'<c r="') == chunk.count(b"<c ") + chunk.count(b"<c>")
        found = (_VALUED_PLAIN if plain else _VALUED).findall(chunk)
        if not found:
            continue
        if r0 is None:
            r0 = int(found[0][1])
        r1 = int(found[-1][1])
        letters.update(f[0] for f in found)
    if r0 is None:
        return None
    cols = [column_index(x.decode()) for x in letters]
    return r0, r1, min(cols), max(cols)


# Column-at-a-time decoding of one chunk: one regular-expression pass collects
# every cell (reference, attributes, body); the requested cells' values are
# then resolved with Arrow compute kernels and numpy (shared-string take,
# number casts, serial-date arithmetic) instead of a Python call per cell.
# A chunk whose markup does not fit the plain form is left to the row loop.
_FAST_CELL = re.compile(rb'<c r="([A-Z]+)([0-9]+)"([^>]*?)(?:/>|>([^<]*(?:<(?!/c>)[^<]*)*)</c>)')
_FAST_ROW = re.compile(rb'<row r="([0-9]+)"')
_MS_PER_DAY = 86_400_000


def _vector_values(book: Workbook, attrs, inner) -> list:
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    m = len(inner)
    out = np.empty(m, dtype=object)
    attrs_a = pa.array(attrs, pa.binary()).cast(pa.string())
    inner_a = pa.array(inner, pa.binary()).cast(pa.string())
    kind = pc.fill_null(pc.struct_field(pc.extract_regex(attrs_a, r' t="(?P<t>[A-Za-z]+)"'), [0]), "n")
    v = pc.struct_field(pc.extract_regex(inner_a, r"^<v>(?P<v>[^<&]*)</v>$"), [0])
    has_v = pc.is_valid(v)
    done = np.zeros(m, dtype=bool)

    shared_mask = pc.and_(pc.equal(kind, "s"), has_v).to_numpy(zero_copy_only=False)
    if shared_mask.any():
        idx = pc.cast(pc.filter(v, pa.array(shared_mask)), pa.int64())
        if getattr(book, "_shared_arrow", None) is None:
            book._shared_arrow = pa.array(book.shared, pa.string())  # once per workbook, not per chunk
        out[shared_mask] = book._shared_arrow.take(idx).to_numpy(zero_copy_only=False)
        done |= shared_mask

    num_mask = pc.and_(pc.equal(kind, "n"), has_v).to_numpy(zero_copy_only=False)
    if num_mask.any():
        nums = pc.cast(pc.filter(v, pa.array(num_mask)), pa.float64()).to_numpy()
        style = pc.fill_null(pc.cast(pc.struct_field(pc.extract_regex(attrs_a, r' s="(?P<s>[0-9]+)"'), [0]),
                                     pa.int64()), 0).to_numpy()[num_mask]
        flags = np.asarray(book.date_styles + [False], dtype=bool)
        is_date = flags[np.minimum(style, len(flags) - 1)] & (style < len(book.date_styles))
        rendered = np.empty(len(nums), dtype=object)
        # plain numbers: whole values as integers, others in shortest form
        plain = ~is_date
        whole = plain & np.isfinite(nums) & (nums == np.trunc(nums)) & (np.abs(nums) < 1e16)
        if whole.any():
            rendered[whole] = pa.array(nums[whole].astype(np.int64)).cast(pa.string()).to_numpy(zero_copy_only=False)
        rest = plain & ~whole
        if rest.any():
            rendered[rest] = [render_number(float(x)) for x in nums[rest]]
        if is_date.any():
            ms = np.round(nums[is_date] * _MS_PER_DAY).astype(np.int64)
            base = np.datetime64(EPOCH_1904 if book.date1904 else EPOCH_1900, "ms")
            stamps = base + ms.astype("timedelta64[ms]")
            whole_s = (ms % 1000) == 0
            text = np.empty(len(ms), dtype=object)
            if whole_s.any():
                secs = pa.array(stamps[whole_s].astype("datetime64[s]"))
                text[whole_s] = pc.strftime(secs, format="%Y-%m-%d %H:%M:%S").to_numpy(zero_copy_only=False)
            if (~whole_s).any():
                text[~whole_s] = [render_datetime(float(x), book.date1904) for x in nums[is_date][~whole_s]]
            rendered[is_date] = text
        out[num_mask] = rendered
        done |= num_mask

    for i in np.flatnonzero(~done):  # strings with entities, booleans, formulas, inline text
        out[i] = _cell_value(book, attrs[i], inner[i])
    return out


def _chunk_rows(book: Workbook, chunk: bytes, wanted: dict, n: int, lo: int, last_row: int):
    """Rows ``lo``..(last row of the chunk, at most ``last_row``) as (row, cells),
    or None when the chunk's markup is not the plain form."""
    import numpy as np

    found = _FAST_CELL.findall(chunk)
    if len(found) != chunk.count(b"<c ") + chunk.count(b"<c>"):
        return None
    rows = _FAST_ROW.findall(chunk)
    if len(rows) != chunk.count(b"<row ") + chunk.count(b"<row>") or not rows:
        return None
    hi = min(int(rows[-1]), last_row)
    if hi < lo:
        return []
    sel = [f for f in found if f[3] and f[0] in wanted]
    grid = np.full((hi - lo + 1, n), None, dtype=object)
    if sel:
        letters, rnums, attrs, inner = zip(*sel)
        rown = np.array(rnums).astype(np.int64) - lo
        keep = (rown >= 0) & (rown <= hi - lo)
        if keep.any():
            ki = np.flatnonzero(keep)
            slots = np.fromiter((wanted[letters[i]] for i in ki), dtype=np.int64, count=len(ki))
            vals = _vector_values(book, [attrs[i] for i in ki], [inner[i] for i in ki])
            grid[rown[ki], slots] = vals
    return list(zip(range(lo, hi + 1), grid.tolist()))


def sheet_records(book: Workbook, path: str, positions: Sequence[int]
                  ) -> Iterator[tuple[int, list[str | None]]]:
    """Data rows of one sheet as (row number, cells at ``positions``).

    The used range starts at the first row and column holding a value; its
    first row is the header.  Rows missing inside the range come out as
    all-null rows; nothing after the last row holding a value is emitted.
    Cells are expected to carry their ``r`` reference (all common writers
    emit it); a sheet without references is read by the element-tree path.
    """
    rng = _used_range(book, path)
    if rng is None:
        yield from sheet_records_reference(book, path, positions)
        return
    first_row, last_row, first_col, last_col = rng
    width = last_col - first_col + 1
    if positions and max(positions) >= width:
        raise WorkbookError(f"wrong number of columns: {width}; needed: {max(positions) + 1}")
    wanted = {_col_letters(first_col + p).encode(): i for i, p in enumerate(positions)}
    n = len(positions)
    shared = book.shared
    expected = first_row + 1
    rn = 0
    for chunk in _row_chunks(book, path):
        fast = _chunk_rows(book, chunk, wanted, n, max(expected, first_row + 1), last_row)
        if fast is not None:
            for r, cells in fast:
                yield r, cells
            if fast:
                expected = fast[-1][0] + 1
            rows = _FAST_ROW.findall(chunk)
            rn = int(rows[-1]) if rows else rn
            if rn >= last_row:
                return
            continue
        for m in _ROW.finditer(chunk):
            num = _A_ROWNUM.search(m.group(1))
            rn = int(num.group(1)) if num else rn + 1
            if rn <= first_row:
                continue
            if rn > last_row:
                return
            cells: list[str | None] = [None] * n
            body = m.group(2)
            if body:
                for letters, attrs, inner in _CELL.findall(body):
                    i = wanted.get(letters)
                    if i is None or not inner:
                        continue
                    # fast paths: shared string, and plain number without a style
                    if inner[:3] == b"<v>" and inner[-4:] == b"</v>":
                        if b' t="s"' in attrs:
                            cells[i] = shared[int(inner[3:-4])]
                            continue
                        if b' t="' not in attrs and b' s="' not in attrs:
                            cells[i] = render_number(float(inner[3:-4]))
                            continue
                    cells[i] = _cell_value(book, attrs, inner)
            while expected < rn:
                yield expected, [None] * n
                expected += 1
            yield rn, cells
            expected = rn + 1
    while expected <= last_row:
        yield expected, [None] * n
        expected += 1


# ---------------------------------------------------------------- writer (fixtures)

def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def _esc(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def write_workbook(sheets: Sequence[tuple[str, Sequence[Sequence[object]]]], shared: bool = True) -> bytes:
    """Minimal ``.xlsx``: strings (shared or inline), numbers, and datetimes
    as date-styled serials.  ``None`` leaves a gap."""
    strings: dict[str, int] = {}
    sheet_xml = []
    for _, rows in sheets:
        out = ['<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
               f'<worksheet xmlns="{NS[1:-1]}"><sheetData>']
        for r, row in enumerate(rows, start=1):
            out.append(f'<row r="{r}">')
            for ci, v in enumerate(row):
                ref = f"{_col_letters(ci)}{r}"
                if v is None:
                    continue
                if isinstance(v, bool):
                    out.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
                elif isinstance(v, (_dt.datetime, _dt.date)):
                    if not isinstance(v, _dt.datetime):
                        v = _dt.datetime(v.year, v.month, v.day)
                    serial = (v - EPOCH_1900) / _dt.timedelta(days=1)
                    out.append(f'<c r="{ref}" s="1"><v>{serial!r}</v></c>')
                elif isinstance(v, (int, float)):
                    out.append(f'<c r="{ref}"><v>{v!r}</v></c>')
                elif shared:
                    idx = strings.setdefault(str(v), len(strings))
                    out.append(f'<c r="{ref}" t="s"><v>{idx}</v></c>')
                else:
                    out.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{_esc(str(v))}</t></is></c>')
            out.append("</row>")
        out.append("</sheetData></worksheet>")
        sheet_xml.append("".join(out))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Default Extension="xml" ContentType="application/xml"/>'
                   '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
                   + "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                             for i in range(len(sheets)))
                   + '</Types>')
        z.writestr("_rels/.rels",
                   '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
                   '</Relationships>')
        z.writestr("xl/workbook.xml",
                   f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{NS[1:-1]}" xmlns:r="{REL_NS[1:-1]}"><sheets>'
                   + "".join(f'<sheet name="{_esc(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>'
                             for i, (n, _) in enumerate(sheets))
                   + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   + "".join(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>'
                             for i in range(len(sheets)))
                   + f'<Relationship Id="rId{len(sheets) + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/styles" Target="styles.xml"/>'
                   + (f'<Relationship Id="rId{len(sheets) + 2}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/sharedStrings" Target="sharedStrings.xml"/>' if strings else "")
                   + "</Relationships>")
        z.writestr("xl/styles.xml",
                   f'<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="{NS[1:-1]}">'
                   '<numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd\\ hh:mm:ss"/></numFmts>'
                   '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="164" applyNumberFormat="1"/></cellXfs>'
                   '</styleSheet>')
        for i, xml in enumerate(sheet_xml):
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", xml)
        if strings:
            z.writestr("xl/sharedStrings.xml",
                       f'<?xml version="1.0" encoding="UTF-8"?><sst xmlns="{NS[1:-1]}" count="{len(strings)}" uniqueCount="{len(strings)}">'
                       + "".join(f'<si><t xml:space="preserve">{_esc(s)}</t></si>' for s in strings)
                       + "</sst>")
    return buf.getvalue()

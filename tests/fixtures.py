"""Test inputs: minimal .xlsx workbooks built with the standard library and the
report grids described by the reference's reports and tests."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

# ---------------------------------------------------------------- xlsx writer


def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def make_xlsx(sheets: dict[str, list[list]], rich_text: bool = False) -> bytes:
    """A workbook whose sheets hold the given rows (None = empty cell).

    Strings go to the shared-string table (as rich-text runs when asked),
    numbers are stored inline.
    """
    shared: list[str] = []
    index: dict[str, int] = {}

    def sid(s: str) -> int:
        if s not in index:
            index[s] = len(shared)
            shared.append(s)
        return index[s]

    sheet_xml = []
    for rows in sheets.values():
        out = ['<?xml version="1.0" encoding="UTF-8"?>',
               '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>']
        for r, row in enumerate(rows):
            cells = []
            for c, v in enumerate(row):
                if v is None:
                    continue
                ref = f"{_col_letters(c)}{r + 1}"
                if isinstance(v, bool):
                    cells.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
                elif isinstance(v, (int, float)):
                    cells.append(f'<c r="{ref}"><v>{v!r}</v></c>')
                elif isinstance(v, str) and v.startswith("="):
                    cells.append(f'<c r="{ref}"><f>{escape(v[1:])}</f><v>0</v></c>')
                else:
                    cells.append(f'<c r="{ref}" t="s"><v>{sid(v)}</v></c>')
            if cells:
                out.append(f'<row r="{r + 1}">{"".join(cells)}</row>')
        out.append("</sheetData></worksheet>")
        sheet_xml.append("".join(out))

    def si(s: str) -> str:
        if rich_text and len(s) > 1:
            h = len(s) // 2
            return (f'<si><r><t xml:space="preserve">{escape(s[:h])}</t></r>'
                    f'<r><t xml:space="preserve">{escape(s[h:])}</t></r></si>')
        return f'<si><t xml:space="preserve">{escape(s)}</t></si>'

    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        class _Fixed:  # fixed member timestamps: same content -> same bytes -> same hash
            @staticmethod
            def writestr(name, data):
                zf.writestr(zipfile.ZipInfo(name, date_time=(2026, 1, 1, 0, 0, 0)), data)
        z = _Fixed
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/'
                   'package/2006/content-types"></Types>')
        wb = ['<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/'
              'spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/'
              'relationships"><sheets>']
        rels = ['<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/'
                'package/2006/relationships">']
        for i, name in enumerate(sheets):
            wb.append(f'<sheet name="{escape(name)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>')
            rels.append(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/'
                        f'2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>')
        wb.append("</sheets></workbook>")
        rels.append("</Relationships>")
        z.writestr("xl/workbook.xml", "".join(wb))
        z.writestr("xl/_rels/workbook.xml.rels", "".join(rels))
        for i, xml in enumerate(sheet_xml):
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", xml)
        z.writestr("xl/sharedStrings.xml",
                   '<?xml version="1.0" encoding="UTF-8"?><sst xmlns="http://schemas.openxmlformats.org/'
                   'spreadsheetml/2006/main">' + "".join(si(s) for s in shared) + "</sst>")
    return buf.getvalue()


# ---------------------------------------------------------------- disbursement report grid

CGD_SHEET = "2.กระทรวง"
KNOWN_ROW_5 = [1, "กระทรวงคมนาคม", None, 12479.19303697, 12473.29983697, 0, 389.12662731, 9253.39711287,
               74.15060481440203, 187476.73046303, 185040.12706303, 0, 62052.16428664, 97536.98023298,
               52.026179458156314, 199955.9235, 197513.4269, 0, 62441.29091395, 106790.37734585,
               53.40695863198572, "08"]
KNOWN_ROW_28 = [24, "หน่วยงานของศาล", None, 25047.8913, 25047.8913, 0, 0, 25010.6694, 99.85139707149719,
                3142.7785, 3142.7785, 0, 0, 3142.7785, 100, 28190.6698, 28190.6698, 0, 0, 28153.4479,
                99.86796376154213, "28"]
TOTAL_ROW = ["รวม", None, None, 1738211.36895556, 1737519.63765556, 0, 13249.24843399, 1428827.77420152,
             82.20103721103035, 614442.65924444, 603368.00454444, 0, 178970.3685688, 319912.23971383,
             52.06543440639613, 2352654.0282, 2340887.6422, 0, 192219.61700279, 1748740.01391535,
             74.33052174072952, " "]


def cgd_grid(zero_row: bool = True) -> list[list]:
    rows: list[list] = [["ผลการเบิกจ่ายงบประมาณ"], ["ณ วันที่ 3 กรกฎาคม 2569"], ["หน่วย : ล้านบาท"]]
    header = [None] * 22
    header[0], header[1], header[3], header[9], header[15], header[21] = (
        "ลำดับ\nที่", "กระทรวง", "รายจ่ายประจำ", "รายจ่ายลงทุน", "รวม", "รหัสกระทรวง")
    sub = [None] * 22
    sub[3], sub[7] = "วงเงิน\nงบประมาณ\nหลังโอน\nเปลี่ยนแปลง", "เบิกจ่าย"
    rows += [header, sub, KNOWN_ROW_5]
    for i in range(2, 24):
        seq = i
        if zero_row and i == 2:
            # Zero-denominator ministry: recurring all 0; capital and total 100/100/0/0/50.
            rows.append([seq, "กระทรวงทดสอบศูนย์", None, 0, 0, 0, 0, 0, 0, 100, 100, 0, 0, 50, 50,
                         100, 100, 0, 0, 50, 50, "99"])
            continue
        b = 1000.0 + i
        rows.append([seq, f"กระทรวงตัวอย่าง{i}", None, b, b, 0, 1.5, b / 2, 50.0, b * 2, b * 2, 0, 2.5, b,
                     50.0, b * 3, b * 3, 0, 4.0, b * 1.5, 50.0, f"{i + 30:02d}"])
    rows += [KNOWN_ROW_28, TOTAL_ROW, [], ["หมายเหตุ : ข้อมูลจากระบบ"], [], [], [], [], ["แหล่งที่มา"]]
    return rows


# ---------------------------------------------------------------- workforce report grid

OCSC_SHEET = "12"
OCSC_ROWS = [
    ("รวมทั้งหมด", 3004485), ("ข้าราชการ", 1756606), ("ครูและบุคลากรทางการศึกษา", 444168),
    ("พลเรือนสามัญ", 414088), ("ทหาร", 368711), ("ตำรวจ", 213086), ("พนักงานส่วนตำบล", 81163),
    ("พนักงานเทศบาล", 70367), ("ครูส่วนท้องถิ่น", 53574), ("กรุงเทพมหานคร", 35126),
    ("องค์การบริหารส่วนจังหวัด", 27833), ("องค์กรอิสระตามรัฐธรรมนูญ ", 26364),
    ("พลเรือนในสถาบันอุดมศึกษา", 9408), ("ตุลาการ", 5297), ("อัยการ", 4257), ("รัฐสภาสามัญ", 3164),
    ("กำลังคนประเภทอื่น", 1247879), ("ลูกจ้างชั่วคราว", 271917), ("พนักงานจ้าง", 223528),
    ("พนักงานรัฐวิสาหกิจ", 219014), ("พนักงานราชการ", 179567), ("พนักงานมหาวิทยาลัย", 136859),
    ("พนักงานกระทรวงสาธารณสุข", 121285), ("ลูกจ้างประจำ", 82111), ("พนักงานองค์การมหาชน", 13598),
]


def ocsc_grid() -> list[list]:
    total = OCSC_ROWS[0][1]
    rows: list[list] = [["กำลังคนภาครัฐ"], ["ปีงบประมาณ พ.ศ. 2567"], ["ประเภท", "จำนวน", "ร้อยละ"]]
    rows += [[n, v, round(v / total * 100, 2)] for n, v in OCSC_ROWS]
    rows += [["หมายเหตุ : ตัวเลขรวมจากหลายแหล่ง"], [], [], []]
    return rows


def write(path: str, data: bytes) -> str:
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    return path


def sha256(data: bytes) -> str:
    import hashlib
    return hashlib.sha256(data).hexdigest()


def plan_text(df) -> str:
    """The physical plan as ``explain()`` prints it (final adaptive plan once executed)."""
    import contextlib
    import io as _io
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()

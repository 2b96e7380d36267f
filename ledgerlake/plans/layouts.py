"""Report layouts as data: which sheet, which rows, which columns, which anchors.

Indices are 0-based; row ranges are inclusive. Layouts are configuration, so
the DataFrames built from them are small and broadcast by construction.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# The disbursement report (sheet, rows, columns, header anchors).
# ---------------------------------------------------------------------------
CGD_SHEET = "2.กระทรวง"
CGD_DATA_ROWS = (5, 28)
CGD_TOTAL_ROW = 29
CGD_MEASURES = ("budget_after_transfer", "allocated", "spending_plan", "po_reserved", "disbursed")
CGD_COLUMNS = {
    "seq_no": 0,
    "ministry_name": 1,
    "recurring_budget_after_transfer": 3, "recurring_allocated": 4, "recurring_spending_plan": 5,
    "recurring_po_reserved": 6, "recurring_disbursed": 7,
    "capital_budget_after_transfer": 9, "capital_allocated": 10, "capital_spending_plan": 11,
    "capital_po_reserved": 12, "capital_disbursed": 13,
    "total_budget_after_transfer": 15, "total_allocated": 16, "total_spending_plan": 17,
    "total_po_reserved": 18, "total_disbursed": 19,
    "ministry_code": 21,
}
CGD_ANCHORS = (
    (3, 0, "ลำดับ\nที่"),
    (3, 1, "กระทรวง"),
    (3, 3, "รายจ่ายประจำ"),
    (3, 9, "รายจ่ายลงทุน"),
    (3, 15, "รวม"),
    (3, 21, "รหัสกระทรวง"),
    (4, 3, "วงเงิน\nงบประมาณ\nหลังโอน\nเปลี่ยนแปลง"),
    (4, 7, "เบิกจ่าย"),
    (29, 0, "รวม"),
)
# Expense-type groups: (column prefix, expense_type_name, is_leaf). 'รวม' is the
# rollup of the other two and is not a leaf.
CGD_GROUPS = (
    ("recurring", "รายจ่ายประจำ", True),
    ("capital", "รายจ่ายลงทุน", True),
    ("total", "รวม", False),
)

# ---------------------------------------------------------------------------
# The workforce report (sheet, section rows, columns).
# ---------------------------------------------------------------------------
OCSC_SHEET = "12"
OCSC_COLUMNS = {"category_name": 0, "headcount": 1, "percent": 2}
# (hierarchy_level, first row, last row, parent row)
OCSC_SECTIONS = (
    (0, 3, 3, None),
    (1, 4, 4, 3),
    (2, 5, 18, 4),
    (1, 19, 19, 3),
    (2, 20, 27, 19),
)


@dataclass(frozen=True)
class Layout:
    sheet: str
    columns: dict[str, int]
    data_rows: tuple[int, int] | None = None
    sections: tuple = ()
    anchors: tuple = ()
    extra: dict = field(default_factory=dict)

    @property
    def row_ranges(self) -> list[tuple[int, int]]:
        """The inclusive ranges of the rows that every report of this layout must hold."""
        return [self.data_rows] if self.data_rows else [(first, last) for _, first, last, _ in self.sections]


CGD_LAYOUT = Layout(sheet=CGD_SHEET, columns=CGD_COLUMNS, data_rows=CGD_DATA_ROWS, anchors=CGD_ANCHORS)
OCSC_LAYOUT = Layout(sheet=OCSC_SHEET, columns=OCSC_COLUMNS, sections=OCSC_SECTIONS)

import json

from fixtures import CGD_SHEET, OCSC_SHEET, cgd_grid, make_xlsx, ocsc_grid, sha256, write
from ledgerlake.__main__ import main


def test_load_and_counts_commands(spark, scratch, capsys):
    cgd = make_xlsx({CGD_SHEET: cgd_grid()})
    ocsc = make_xlsx({OCSC_SHEET: ocsc_grid()})
    write(f"{scratch}/raw/cgd/2026_07_03.xlsx", cgd)
    write(f"{scratch}/raw/ocsc/thaigovmanpower2567_4.xlsx", ocsc)
    doc = {"files": [
        {"source": "CGD", "source_url": "https://example.org/cgd", "local_path": "raw/cgd/2026_07_03.xlsx",
         "report_date": "2026-07-03", "sha256": sha256(cgd)},
        {"source": "OCSC", "source_url": "https://example.org/ocsc",
         "local_path": "raw/ocsc/thaigovmanpower2567_4.xlsx", "fiscal_year_be": 2567, "sha256": sha256(ocsc)}]}
    with open(f"{scratch}/manifest.json", "w", encoding="utf-8") as f:
        json.dump(doc, f, ensure_ascii=False)
    args = ["load", "--cgd", f"{scratch}/raw/cgd", "--ocsc", f"{scratch}/raw/ocsc",
            "--manifest", f"{scratch}/manifest.json", "--warehouse", f"{scratch}/wh"]
    assert main(args) == 0
    assert "fact_disbursement: 72 new rows" in capsys.readouterr().out
    assert main(args) == 0                                        # rerun: nothing new
    assert "fact_disbursement: 0 new rows" in capsys.readouterr().out
    assert main(["counts", "--warehouse", f"{scratch}/wh"]) == 0
    out = capsys.readouterr().out
    assert "fact_workforce_summary: 25 rows" in out and "dim_ministry: 24 rows" in out


def test_check_command(spark, scratch, capsys):
    from test_listing import PREFIX, _page, _row
    write(f"{scratch}/pages/listing.html", _page([_row("30/06/2569", 1), _row("03/07/2569", 1438191564296)])
          .encode("utf-8"))
    doc = {"files": [{"source": "CGD", "source_url": "https://example.org", "local_path": "raw/cgd/2026_06_30.xlsx",
                      "report_date": "2026-06-30", "sha256": "h"}]}
    with open(f"{scratch}/manifest.json", "w", encoding="utf-8") as f:
        json.dump(doc, f)
    code = main(["check", "--pages", f"{scratch}/pages", "--manifest", f"{scratch}/manifest.json",
                 "--prefix", PREFIX, "--base-url", "https://www.cgd.go.th"])
    out = capsys.readouterr().out
    assert code == 0 and "CGD: new 2026-07-03 https://www.cgd.go.th/cs/Satellite?" in out

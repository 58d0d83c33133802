"""Small hand-written source files."""

from __future__ import annotations

from pathlib import Path

from semestra.plans.loading import Inputs, PriceSource

PRICE_HEADER = "freq,siec,nrg_cons,unit,tax,currency,geo\\TIME_PERIOD"


def write_tsv(path: Path, header: list[str], lines: list[list[str]]) -> str:
    text = "\n".join("\t".join(cells) for cells in [header, *lines]) + "\n"
    path.write_text(text, encoding="utf-8")
    return str(path)


def write_codelists(path: Path, lists: dict[str, list[str]]) -> str:
    """An SDMX-like file with namespaces; labels in German first, then English."""
    body = []
    for name, codes in lists.items():
        entries = "".join(
            f'<s:Code id="{code}"><c:Name xml:lang="de">Kode {code}</c:Name>'
            f'<c:Name xml:lang="en">Label {code}</c:Name></s:Code>'
            for code in codes
        )
        body.append(f'<s:Codelist id="{name}">{entries}</s:Codelist>')
    path.write_text(
        '<?xml version="1.0" encoding="UTF-8"?>\n'
        '<m:Structure xmlns:m="urn:m" xmlns:s="urn:s" xmlns:c="urn:c"><m:Structures><s:Codelists>'
        + "\n".join(body) + "</s:Codelists></m:Structures></m:Structure>\n",
        encoding="utf-8",
    )
    return str(path)


CODELISTS = {
    "SIEC": ["G3000", "E7000", "TOTAL"],
    "NRG_CONS": ["TOT_KWH", "KWH_LT1000", "KWH1000-2499", "KWH2500-4999"],
    "UNIT": ["KWH", "GJ_GCV", "PC"],
    "TAX": ["X_TAX", "X_VAT", "I_TAX", "Z_TAX"],
    "CURRENCY": ["EUR", "PPS"],
}

PRICE_LINES = [
    ["S,E7000,KWH2500-4999,KWH,X_VAT,EUR,IT", "0.0969 ", "0.1234 e", ": "],
    ["S,E7000,KWH2500-4999,KWH,X_VAT,EUR,DE", "0.2 ep", ": c", "0.30005 "],
    ["S,E7000,KWH_LT1000,KWH,X_VAT,EUR,IT", "-0.1 ", "", "1.2.3"],
    ["S,E7000,TOT_KWH,KWH,I_TAX,EUR,EU27_2020", "0.5 e p", "0.25 ", ": "],
]


def price_source(
    folder: Path, lines=None, header=PRICE_HEADER, periods=("2007-S1 ", "2007-S2 ", "2008-S1 "),
    codelists=None, dataset="nrg_pc_204",
) -> PriceSource:
    folder.mkdir(parents=True, exist_ok=True)
    path = write_tsv(folder / f"{dataset}.tsv", [header, *periods], PRICE_LINES if lines is None else lines)
    xml = write_codelists(folder / f"{dataset}.xml", CODELISTS if codelists is None else codelists)
    return PriceSource(dataset, path, xml, "ELECTRICITY", "HOUSEHOLD", "E7000")


def dependency_files(folder: Path, lines=None) -> tuple[str, str]:
    folder.mkdir(parents=True, exist_ok=True)
    lines = lines or [
        ["A,TOTAL,PC,IT", "73.45678 ", ": "],
        ["A,TOTAL,PC,DE", "-12.5 p", "60.1 "],
        ["A,G3000,PC,IT", "91.2 ", "90 e"],
    ]
    path = write_tsv(folder / "dependency.tsv", ["freq,siec,unit,geo\\TIME_PERIOD", "2007 ", "2008 "], lines)
    return path, write_codelists(folder / "dependency.xml", CODELISTS)


def stock_file(folder: Path, lines=None) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    lines = lines or [
        ["M,STK_EUE_DIR,NR,IT", "100.5 ", "0 ", "90 e"],
        ["M,STK_EUE_DIR,NR,DE", "0.00 ", ": ", "7 "],
        ["M,IC_DC,THS_T,IT", "55 ", "56 ", "57 "],
        ["M,STK_EUE_MTH,NR,IT", "1 ", "1 ", "2 "],
    ]
    return write_tsv(
        folder / "stocks.tsv", ["freq,stk_flow,unit,geo\\TIME_PERIOD", "2013-01 ", "2013-02 ", "2013-03 "], lines
    )


INDEX_LINES = [
    "1900-01-01,50.1,51.2,49.3,x",
    "1984-12-01,70.1,71.2,69.3,x",
    "1985-01-01,80.12345,81.2,79.3,x",
    "1985-02-01,90.1,91.2,89.3,x",
    "1985-03-01,,,,x",
    "bad,,,,x",
]


def index_file(folder: Path, lines=None) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / "index.csv"
    path.write_text("\n".join([" Month,GPR ,GPRT,gpra,OTHER", *(lines or INDEX_LINES)]) + "\n")
    return str(path)


def all_inputs(folder: Path) -> Inputs:
    dependency, dependency_codelists = dependency_files(folder)
    return Inputs([price_source(folder)], dependency, dependency_codelists, stock_file(folder), index_file(folder))

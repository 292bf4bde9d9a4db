"""Innovation cells (a 0/1 flag with a note) and the combined evidence note."""

from pyspark.sql import Column, DataFrame, functions as F

from firmament.functions.numbers import stripped_to_double
from firmament.functions.text import empty_to_null, null_words_to_null, strip

# Spoken forms of the flag, and the labels inside a combined note.
YES_WORDS = ("yes", "true", "có", "co")
NO_WORDS = ("no", "false", "không", "khong")
PRODUCT_LABEL = "Product: "
PROCESS_LABEL = "Process: "


def with_innovation(df: DataFrame, cells: dict[str, Column]) -> DataFrame:
    """Add ``<name>_flag`` (0, 1 or NULL) and ``<name>_note`` for each innovation cell.

    A cell is a pure number, cut to a whole one; or a 0 or 1 with a note in parentheses; or a spoken
    yes or no; or else a note without a flag. The steps are projected one by one, so each is worked
    out once and the generated code stays small.
    """
    def per_cell(make) -> dict[str, Column]:
        return {name: c for cell in cells for name, c in make(cell).items()}

    df = df.withColumns({f"_{n}_text": null_words_to_null(c) for n, c in cells.items()})
    df = df.withColumns(per_cell(lambda n: {
        f"_{n}_head": F.substring(f"_{n}_text", 1, 1),
        f"_{n}_rest": F.ltrim(F.substring(f"_{n}_text", 2, 2**31 - 1), F.lit(" \t\n\r\f\x0b\xa0")),
        f"_{n}_word": F.lower(f"_{n}_text"),
    }))

    def look(n: str) -> dict[str, Column]:
        head, rest = F.col(f"_{n}_head"), F.col(f"_{n}_rest")
        return {
            f"_{n}_flagged": head.isin("0", "1") & ((rest == "") | (rest.startswith("(") & rest.endswith(")"))),
            # Only texts that start like a number are looked at more closely.
            f"_{n}_number": F.when(head.between("+", "9"), stripped_to_double(F.col(f"_{n}_text"))),
        }

    df = df.withColumns(per_cell(look))

    def result(n: str) -> dict[str, Column]:
        text, word, rest = F.col(f"_{n}_text"), F.col(f"_{n}_word"), F.col(f"_{n}_rest")
        flagged, number = F.col(f"_{n}_flagged"), F.col(f"_{n}_number")
        return {
            f"{n}_flag": F.when(flagged, F.col(f"_{n}_head").try_cast("int"))
            .when(word.isin(*YES_WORDS), F.lit(1))
            .when(word.isin(*NO_WORDS), F.lit(0))
            .when((number > -1) & (number < 2), number.try_cast("int")),
            f"{n}_note": F.when(flagged, empty_to_null(strip(F.substring(rest, F.lit(2), F.length(rest) - 2))))
            .when(~word.isin(*YES_WORDS, *NO_WORDS) & number.isNull(), text),
        }

    steps = ("text", "head", "rest", "word", "flagged", "number")
    return df.withColumns(per_cell(result)).drop(*[f"_{n}_{step}" for n in cells for step in steps])


def combined_note(product: Column, process: Column) -> Column:
    """``Product: a | Process: b``, leaving out an absent note; NULL when both are absent.

    Notes come stripped from ``with_innovation``.
    """
    return empty_to_null(F.concat_ws(
        " | ",
        F.concat(F.lit(PRODUCT_LABEL), product),
        F.concat(F.lit(PROCESS_LABEL), process),
    ))


def note_part(note: Column, label: str) -> Column:
    """Lower-case content after ``label`` in a combined note; NULL when there is none.

    The last labelled part counts; left-over "nan" and "none" do not.
    """
    parts = F.filter(F.split(F.lower(note), r"[|]"), lambda p: p.contains(label))
    text = F.try_element_at(parts, F.lit(-1))
    for word in (label, "nan", "none"):
        text = F.replace(text, F.lit(word), F.lit(""))
    return empty_to_null(strip(text))

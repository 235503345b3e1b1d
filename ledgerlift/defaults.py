"""The bank's vocabulary. Every operator takes these as default arguments."""

# Results depend on each of them.
MONEY_SYMBOLS = "$,"
CURRENCY_WORD = "MXN"
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM-dd-yyyy", "dd-MMM-yyyy", "yyyy/MM/dd")
LABEL_KEEP = r"\p{Alnum}áéíóúÁÉÍÓÚñÑ "  # \p{Alnum} is a-zA-Z0-9, and much faster than that
INCOME = "INGRESO"
EXPENSE = "EGRESO"
MOVEMENT_WORDS = {
    INCOME: ("ABONO", "INGRESO", "CREDITO", "CR"),
    EXPENSE: ("CARGO", "EGRESO", "DEBITO", "DB"),
}

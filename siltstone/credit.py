"""The credit-risk tables: column families, bands and keys (one configuration).

All values below are fixed values of the data model.
"""

KEYS = ("Customer_ID", "snapshot_date")

CLICK_FEATURES = tuple(f"fe_{i}" for i in range(1, 21))

ACCOUNT_COUNTS = (
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
)
INQUIRIES = "Num_Credit_Inquiries"
COUNT_COLUMNS = (*ACCOUNT_COUNTS, INQUIRIES)

LOAN_COUNT_COLUMNS = ("tenure", "installment_num")

LOAN_MONEY_COLUMNS = ("loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance")

MIN_PAYMENT_ANSWERS = ("Yes", "No", "NM")

UNKNOWN_OCCUPATION = "_______"

# What dirty amounts are stripped of.
DIRT = r"[^\d.]"

# Inclusive upper bound and label.
AGE_BANDS = (
    (17, "<18"),
    (25, "18-25"),
    (35, "26-35"),
    (45, "36-45"),
    (55, "46-55"),
    (65, "56-65"),
    (75, "66-75"),
    (None, "76+"),
)
AGE_LABELS = tuple(label for _, label in AGE_BANDS)
AGE_LABELS_REMOVED = ("<18", "66-75", "76+")


def _ages_kept() -> tuple[int, int]:
    """The first and the last age of the bands that are kept, which lie side by side."""
    kept = [i for i, (_, label) in enumerate(AGE_BANDS) if label not in AGE_LABELS_REMOVED]
    return AGE_BANDS[kept[0] - 1][0] + 1, AGE_BANDS[kept[-1]][0]


AGES_KEPT = _ages_kept()

SPEND_LEVEL = r"^(High|Low)_spent_"
PAYMENT_VALUE = r"_spent_(Small|Medium|Large)_value$"
SPEND_AND_VALUE = r"^(High|Low)_spent_(Small|Medium|Large)_value"

FIRST_SNAPSHOT = "2023-01-01"
LAST_SNAPSHOT = "2024-12-01"

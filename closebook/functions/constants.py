"""Fixed values of the management-control model.

These values must equal the reference model's for matching results; they
are listed plainly, in natural order. Labels are plain ASCII by default and
every operator takes its own labels as parameters.
"""

# --- Fixed values: monthly seasonality coefficients, January..December ---
SEASONALITY = {
    1: 1.15, 2: 0.70, 3: 0.90, 4: 0.95, 5: 1.00, 6: 0.95,
    7: 1.20, 8: 0.60, 9: 1.00, 10: 1.05, 11: 1.55, 12: 1.65,
}

# --- Fixed values: budget status thresholds on the unrounded variance ratio ---
STATUS_STRONG_UNDER = -0.10
STATUS_UNDER = -0.05
STATUS_OVER = 0.05
STATUS_LABELS = {
    "strong_under": "Strong underperformance",
    "under": "Underperformance",
    "over": "Overperformance",
    "on_track": "On track",
}

# --- Fixed values: z-score severities ---
Z_MAJOR = 3.0
Z_SIGNIFICANT = 2.0
SEVERITY_LABELS = {"major": "Major anomaly", "significant": "Significant drift", "normal": "Normal"}

# --- Fixed values: DSO alert rules of the reference (channel, threshold in days, label) ---
DSO_ALERT_RULES = [
    ("Marketplace", 55.0, "Marketplace DSO degraded"),
    ("Web", 3.0, "Web payment anomaly"),
]

# --- Fixed values: generator multipliers ---
GROWTH_N = 0.12                 # revenue target growth N vs N-1
PRICE_UPMARKET = 1.30           # category price rise in N
PRICE_MARKDOWN = 0.85           # September markdown in N
PRICE_SALE = 0.70               # January / July sales
SALE_MONTHS = (1, 7)
MARKDOWN_MONTH = 9
OVERSTOCK_FACTOR = 1.6          # purchase quantity multiplier (March-April N)
OVERSTOCK_MONTHS = (3, 4)
FREIGHT_RATE = 0.03
FREIGHT_RATE_FROM_STEP = 0.0345
FREIGHT_STEP_MONTH = 6
EXPENSE_INFLATION = 1.03
MARKETING_PEAK = 1.5
MARKETING_PEAK_MONTHS = (10, 11)
CHARGE_SPIKE = 1.40
CHARGE_SPIKE_MONTHS = (4, 5, 6)
PAYROLL_RAISE_N = 1.025
PAYROLL_DECEMBER = 1.8
BLACK_FRIDAY_FROM_DAY = 20
CHRISTMAS_LAST_DAY = 24

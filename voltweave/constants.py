"""Fixed values of the load-survey rules."""

# What the readings hold, and the limits that the rules test.
VOLTS = ("VR", "VY", "VB")
AMPS = ("IR", "IY", "IB")
KW = ("KW_R", "KW_Y", "KW_B")
KVAR = ("KVAR_R", "KVAR_Y", "KVAR_B")
ENERGY = "KWH_TOTAL"
PARAMETERS = (*VOLTS, *AMPS, *KW, *KVAR, ENERGY)
EXEMPT_CATEGORIES = ("MHVD", "HVDAF")
V_MIN, V_MAX = 180.0, 290.0
I_MAX = 5000.0
KVAR_MIN = -10.0
PHASE_LOSS_KW, PHASE_LOSS_KVAR = 0.02, 0.02
ROLLING_ROWS, LOOKBACK_DAYS, BAND = 7, 7, 0.05
SLOTS_15_MINUTES = 60
LOADING_BANDS = (("70-80%", 0.70, 0.80), ("80-90%", 0.80, 0.90), ("90-100%", 0.90, 1.00), ("100-110%", 1.00, 1.10), ("110-120%", 1.10, 1.20), (">120%", 1.20, None))
SUSTAINED_HOURS = 30.0
LINEAR_GAP, QUADRATIC_GAP, FIT_WINDOW = 2, 4, 6
REGRESSION_DAYS, BOOSTING_DAYS, BOOSTING_ROWS = 120, 180, 50
HEALTHY_PERCENT = 50.0

"""Texts and names the reference's outputs use, kept as they are.

Fixed values (must equal the reference's output for the same results):
"""

# Claim flag texts, in the order (expected < actual, otherwise).
ABNORMAL_CLAIM = "Abnormal Claim"
NORMAL_CLAIM = "Normal Claim"

# Class labels of the fraud prediction, for classes 0 and 1.
POLICY_LABELS = {0: "Normal Policy", 1: "Abnormal Policy"}

# Output column names of the two scoring functions.
EXPECTED_COL = "Expected_Expenses"
ACTUAL_COL = "Actual_Expenses"
STATUS_COL = "Claim_Status"
PREDICTION_TEXT_COL = "Model Prediction"

"""Column names, types and encodings of the four sources and their tables."""

from __future__ import annotations

KEYS = ["customer_id", "snapshot_date"]
SNAPSHOT = "snapshot_date"

# Raw column names and the names used from silver on.
LOAN_RENAMES = {"Customer_ID": "customer_id"}
CLICKSTREAM_RENAMES = {"Customer_ID": "customer_id"}
ATTRIBUTE_RENAMES = {
    "Customer_ID": "customer_id",
    "Name": "name",
    "Age": "age",
    "SSN": "ssn",
    "Occupation": "occupation",
}
FINANCIAL_RENAMES = {
    "Customer_ID": "customer_id",
    "Annual_Income": "annual_income",
    "Monthly_Inhand_Salary": "monthly_inhand_salary",
    "Num_Bank_Accounts": "num_bank_accounts",
    "Num_Credit_Card": "num_credit_card",
    "Interest_Rate": "interest_rate",
    "Num_of_Loan": "num_of_loan",
    "Type_of_Loan": "type_of_loan",
    "Delay_from_due_date": "delay_from_due_date",
    "Num_of_Delayed_Payment": "num_of_delayed_payment",
    "Changed_Credit_Limit": "changed_credit_limit",
    "Num_Credit_Inquiries": "num_credit_inquiries",
    "Credit_Mix": "credit_mix",
    "Outstanding_Debt": "outstanding_debt",
    "Credit_Utilization_Ratio": "credit_utilization_ratio",
    "Credit_History_Age": "credit_history_age",
    "Payment_of_Min_Amount": "payment_of_min_amount",
    "Total_EMI_per_month": "total_emi_per_month",
    "Amount_invested_monthly": "amount_invested_monthly",
    "Payment_Behaviour": "payment_behaviour",
    "Monthly_Balance": "monthly_balance",
}

# Columns of the raw files, in their order.
RAW_COLUMNS = {
    "loans": [
        "loan_id",
        "Customer_ID",
        "loan_start_date",
        "tenure",
        "installment_num",
        "loan_amt",
        "due_amt",
        "paid_amt",
        "overdue_amt",
        "balance",
        "snapshot_date",
    ],
    "clickstream": [*(f"fe_{i}" for i in range(1, 21)), "Customer_ID", "snapshot_date"],
    "attributes": [*ATTRIBUTE_RENAMES, "snapshot_date"],
    "financials": [*FINANCIAL_RENAMES, "snapshot_date"],
}

# Types of the silver tables.
LOAN_TYPES = {
    "loan_id": "string",
    "customer_id": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}
CLICKSTREAM_TYPES = {
    **{f"fe_{i}": "int" for i in range(1, 21)},
    "customer_id": "string",
    "snapshot_date": "date",
    "loan_id": "string",
}
ATTRIBUTE_TYPES = {
    "customer_id": "string",
    "name": "string",
    "age": "int",
    "ssn": "string",
    "snapshot_date": "date",
}
FINANCIAL_TYPES = {
    "customer_id": "string",
    "annual_income": "float",
    "monthly_inhand_salary": "float",
    "num_bank_accounts": "int",
    "num_credit_card": "int",
    "interest_rate": "int",
    "num_of_loan": "int",
    "delay_from_due_date": "int",
    "num_of_delayed_payment": "int",
    "changed_credit_limit": "float",
    "num_credit_inquiries": "int",
    "credit_mix": "string",
    "outstanding_debt": "float",
    "credit_utilization_ratio": "float",
    "credit_history_age": "string",
    "payment_of_min_amount": "string",
    "total_emi_per_month": "float",
    "amount_invested_monthly": "float",
    "payment_behaviour": "string",
    "monthly_balance": "float",
    "snapshot_date": "date",
    "credit_mix_encoded": "int",
    "credit_history_years": "int",
    "credit_history_months": "int",
    "credit_history_months_total": "int",
    "spending_level_encoded": "int",
    "transaction_value_encoded": "int",
    "loan_type_count_sum": "int",
}

# Cleaning rules of the financial source.
UNDERSCORE_COLUMNS = [
    "annual_income",
    "num_of_delayed_payment",
    "changed_credit_limit",
    "credit_mix",
    "outstanding_debt",
    "amount_invested_monthly",
    "monthly_balance",
]
BLANK_COLUMNS = ["type_of_loan", "credit_mix", "changed_credit_limit"]
GARBAGE_TOKEN = "!@9#%8"
NO_LOAN_TYPE = "Not Specified"
QUANTILE_CLIPPED = [
    "annual_income",
    "monthly_inhand_salary",
    "changed_credit_limit",
    "outstanding_debt",
    "credit_utilization_ratio",
    "total_emi_per_month",
    "amount_invested_monthly",
    "monthly_balance",
]
UPPER_QUANTILE = 0.999
FIXED_CAPS = {
    "interest_rate": 40,
    "num_bank_accounts": 15,
    "num_credit_card": 20,
    "num_credit_inquiries": 30,
    "num_of_delayed_payment": 30,
    "delay_from_due_date": 100,
}
LOAN_KINDS = [
    "Auto Loan",
    "Credit-Builder Loan",
    "Debt Consolidation Loan",
    "Home Equity Loan",
    "Mortgage Loan",
    "Not Specified",
    "Payday Loan",
    "Personal Loan",
    "Student Loan",
]

# Ordinal scales.
CREDIT_MIX_SCALE = {"Good": 3, "Standard": 2, "Bad": 1}
SPENDING_SCALE = {"High_spent%": 2, "Low_spent%": 1}
TRANSACTION_SCALE = {"Large_value": 3, "Medium_value": 2, "Small_value": 1}

# Attribute formats.
SSN_FORMAT = r"^\d{3}-\d{2}-\d{4}$"

# Ids and amounts, raw and typed: their values seldom repeat within a file, so a dictionary of them costs time and saves no bytes.
SELDOM_REPEATED = {
    "loan_id",
    "Customer_ID",
    "customer_id",
    "loan_amt",
    "due_amt",
    "paid_amt",
    "overdue_amt",
    "balance",
    "Name",
    "name",
    "SSN",
    "ssn",
    *QUANTILE_CLIPPED,
    *(raw for raw, typed in FINANCIAL_RENAMES.items() if typed in QUANTILE_CLIPPED),
}

# Feature tables.
MODE_IMPUTED = [
    "credit_mix_encoded",
    "spending_level_encoded",
    "transaction_value_encoded",
    "num_credit_inquiries",
]
GOLD_DROPPED = [
    "name",
    "ssn",
    "credit_mix",
    "num_of_loan",
    "credit_history_years",
    "credit_history_months",
    "payment_behaviour",
    "credit_history_age",
    "payment_of_min_amount",
]
LABEL_COLUMNS = ["loan_id", "customer_id", "label", "label_def", "snapshot_date"]

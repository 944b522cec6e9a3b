"""The words by which the source tables and the reports name the systems."""

# company column of the paid-versus-expected report
PAID_COMPANY = {"metered": "fenix", "snapshot": "paygee", "benchmark": "alms"}
# company column of the first-payment profile
PROFILE_COMPANY = {"metered": "Fenix", "snapshot": "Mobisol", "benchmark": "Alms"}
# source column of the orphan report
ORPHAN_SOURCE = {"metered": "fenixdb", "snapshot": "admin", "benchmark": "alms"}
# source column of the loan accounts
ACCOUNT_SOURCE = {"snapshot": "admin", "benchmark": "alms"}
# source of the channel mapping that covers the snapshot and benchmark systems
CHANNEL_SOURCE = "Solarhub"
# loan types
PAYGO, ARREARS = "paygo", "arrears"
# category and segment of the items that stand for a loan; account type of a loan
LOAN_CATEGORY, CREDIT = "ReadyPay", "CREDIT"

"""ledgerloom: company-disclosure analytics as Spark DataFrame operators."""

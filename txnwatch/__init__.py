"""txnwatch: transaction surveillance written as lazy PySpark DataFrame operators."""

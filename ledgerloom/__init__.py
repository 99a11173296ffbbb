"""Plan-versus-actual analytics as Spark DataFrame operators.

``sources``    contract-driven loading, table sinks and layouts
``functions``  column expressions for text keys, numbers and dates
``operators``  conform, profit-and-loss, currency, allocation and quality steps
``plans``      configured datasets built from the operators
"""

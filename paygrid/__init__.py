"""paygrid: payroll migration and reconciliation as Spark DataFrame jobs.

One wide, denormalised payroll table (one row per payslip line) plus a table of
payroll runs are normalised into employees, employment links, pay codes, payroll
runs, payslip headers, position snapshots and payslip lines; keys are resolved
with a reject log, headers are reconciled against their lines, data-quality
metrics are computed, and one nested document per payslip is built.
"""

__version__ = "0.1.0"

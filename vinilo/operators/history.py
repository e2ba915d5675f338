"""Customers with their sales representative and that one's manager."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinilo.operators.joins import lookup_join


def customer_employee_history(customer: DataFrame, employee: DataFrame) -> DataFrame:
    """One row per customer; those without representative or manager have NULL there."""
    managers = employee.select(
        F.col("EmployeeId").alias("ReportsTo"),
        F.col("FirstName").alias("ManagerFirstName"),
        F.col("LastName").alias("ManagerLastName"),
        F.col("Title").alias("ManagerTitle"),
    )
    employees = employee.select(
        F.col("EmployeeId").alias("SupportRepId"),
        F.col("FirstName").alias("EmployeeFirstName"),
        F.col("LastName").alias("EmployeeLastName"),
        F.col("Title").alias("EmployeeTitle"),
        "ReportsTo",
    )
    customers = customer.select(
        "CustomerId",
        F.col("FirstName").alias("CustomerFirstName"),
        F.col("LastName").alias("CustomerLastName"),
        F.col("Email").alias("CustomerEmail"),
        "Company",
        F.col("Country").alias("CustomerCountry"),
        "SupportRepId",
    )
    representatives = lookup_join(employees, managers, "ReportsTo")
    joined = lookup_join(customers, representatives, "SupportRepId", size_of=employee)
    return joined.select(
        "CustomerId",
        "CustomerFirstName",
        "CustomerLastName",
        "CustomerEmail",
        "Company",
        "CustomerCountry",
        "SupportRepId",
        "EmployeeFirstName",
        "EmployeeLastName",
        "EmployeeTitle",
        "ReportsTo",
        "ManagerFirstName",
        "ManagerLastName",
        "ManagerTitle",
    )

"""lendspark: loan-application data jobs expressed as Spark plans."""

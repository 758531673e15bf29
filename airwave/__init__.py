"""airwave: TV-audience analytics as Spark DataFrame jobs.

Raw set-top-box logs become viewing records, viewing records become user flows,
and both become audience KPIs by hour, day, week and month.
"""

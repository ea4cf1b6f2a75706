"""Operators: lazy ``DataFrame -> DataFrame`` functions, grouped by subject.

marts        M1-M5   sales mart, monthly cube, collections mart, KPI mart
pnl          P1-P7   P&L, mix share, evolution, headline KPIs, filters; X4
variance     V1-V5   budget resolution, budget vs actual, status, monthly roll-up
pvm          E1-E6   price / volume / mix
receivables  R1-R7   collection delay, DSO windows, alerts; X3
drift        A1-A4   trailing z-score on charges; X5 on revenue
controls     Q1-Q4   yearly totals, channel / category mix, growth
planning     G1,G2,G8-G12  calendar, seasonal targets, budgets, schedules
purchasing   G4-G7   price rules, line valuation, demand, purchase costing; X1, X2
lines        G3,G13  running-total cutoff, surrogate keys
"""

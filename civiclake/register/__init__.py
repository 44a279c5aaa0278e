"""The loan-application register: its columns, rules, marts and the flow from file to export."""

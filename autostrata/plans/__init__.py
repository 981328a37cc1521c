"""The tables of the silver and gold layers, their audits, and the jobs that build them."""

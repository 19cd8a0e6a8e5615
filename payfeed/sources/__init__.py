"""Tables in and out: HR tables, marks, delivery log, outbox."""

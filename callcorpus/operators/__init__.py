"""DataFrame -> DataFrame operators.

catalog     tool-catalog rendering and normalisation (F1, F1b, F1c, S5, S7)
formatters  training-text formatters, registry, reject accounting (F2-F9, P1-P4, X1, X2)
scoring     extraction, comparison, aggregation, numbering (J2, J9, C1-C9, N1-N3, W1, P5-P7)
split       exact-size splits, first-N, paging, global row index (T1, T2, L1, L2, C6)
teacher     teacher-reply unpacking (J3-J5, C8, U1)
validate    call validation against a catalog (R1)
tables      paged filters, transcripts, vector search, state (R2-R8)
runlogs     training-log metrics, printed reports, length budget (R9-R11)
"""

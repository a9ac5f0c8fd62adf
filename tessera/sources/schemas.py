"""Table schemas of the reference jobs (S11 and the ledger of S1).

Fixed values: table and column names of the clinical star schema and the
ledger header, in their declared order.
"""

from pyspark.sql import types as T

LEDGER_HEADER = ["Date", "Description", "Amount"]

LEDGER_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in LEDGER_HEADER])

LEDGER_TYPED = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("description", T.StringType()),
    T.StructField("amount", T.DecimalType(18, 2)),
])

_I, _S, _D, _TS = T.IntegerType(), T.StringType(), T.DateType(), T.TimestampNTZType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


CLINICAL = {
    "pazienti": _schema(("ID_Paziente", _I), ("Nome", _S), ("Cognome", _S), ("Data_Nascita", _D),
                        ("Sesso", _S), ("Codice_Fiscale", _S), ("Indirizzo", _S)),
    "ricoveri": _schema(("ID_Ricovero", _I), ("ID_Paziente", _I), ("Data_Inizio", _D), ("Data_Fine", _D),
                        ("Reparto", _S), ("Motivo_Ricovero", _S)),
    "visite": _schema(("ID_Visita", _I), ("ID_Paziente", _I), ("Data_Visita", _D), ("Tipo_Visita", _S),
                      ("Medico", _S), ("Note", _S)),
    "terapie": _schema(("ID_Terapia", _I), ("ID_Paziente", _I), ("Data_Inizio", _D), ("Data_Fine", _D),
                       ("Farmaco", _S), ("Dosaggio", _S), ("Medico_Prescrittore", _S)),
    "sensori_iot": _schema(("ID_Rilevazione", _I), ("ID_Paziente", _I), ("Timestamp", _TS),
                           ("Tipo_Sensore", _S), ("Valore", _S), ("Unita_Misura", _S)),
    "utenti": _schema(("ID_Utente", _I), ("Nome", _S), ("Cognome", _S), ("Email", _S), ("Ruolo", _S),
                      ("Reparto", _S)),
    "accessi_log": _schema(("ID_Accesso", _I), ("ID_Utente", _I), ("ID_Paziente", _I), ("Timestamp", _TS),
                           ("Azione", _S)),
    "report_ricoveri": _schema(("Timestamp_Rilevazione", T.TimestampType()), ("Totale_Ricoveri", _I)),
}

# Warehouse table of the price pipeline: (data DATE, prezzo DOUBLE, indice_google_trend INT).
PRICE_FACT = _schema(("data", _D), ("prezzo", T.DoubleType()), ("indice_google_trend", _I))

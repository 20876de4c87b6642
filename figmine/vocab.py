"""Vocabularies.  Every operator takes its vocabulary as a parameter; these are the defaults."""

# Caption patterns, in matching order.
ACCEPT_PATTERNS = (
    r"\bquantum circuit\b", r"\bcircuit diagram\b", r"\bgate sequence\b", r"\bqubit circuit\b", r"\bquantum gate\b", r"\bquantum pooling layer\b",
    r"\bgrover circuit\b", r"\bshor circuit\b", r"\bqaoa circuit\b", r"\bvqe circuit\b", r"\bbell state circuit\b", r"\bentanglement circuit\b",
    r"\bteleportation circuit\b", r"\bsuperdense coding circuit\b", r"\bqft circuit\b", r"\bqpe circuit\b", r"\bhhl circuit\b", r"\bqubit wire\b",
    r"\bquantum wire\b", r"\bcircuit implementation\b", r"\bgate implementation\b", r"\bcontrol qubit\b", r"\btarget qubit\b", r"\bancilla qubit\b",
)
REJECT_PATTERNS = (
    r"\bplot of\b", r"\bgraph of\b", r"\bbar chart\b", r"\bhistogram\b", r"\bscatter plot\b", r"\bline plot\b", r"\bheatmap\b", r"\bcontour plot\b",
    r"\berror rate\b", r"\bfidelity plot\b", r"\bprobability distribution\b", r"\bresults plot\b", r"\bperformance plot\b",
    r"\belectrical circuit\b", r"\belectronic circuit\b", r"\bclassical circuit\b", r"\bflow ?chart\b", r"\bblock diagram\b", r"\bflow diagram\b",
    r"\barchitecture diagram\b", r"\bsystem diagram\b", r"\bnetwork topology\b", r"\bdata flow\b", r"\bexperimental setup\b", r"\bprotocol diagram\b",
    r"\bschematic diagram\b", r"\bunitary matrix\b", r"\bdensity matrix\b", r"\bstate matrix\b", r"\boperator matrix\b", r"\bhamiltonian matrix\b",
    r"\btransformation matrix\b", r"\bmatrix representation\b", r"\bmatrix form\b", r"\bmatrix notation\b", r"\blattice\b", r"\btensor\b", r"\bgauge\b",
    r"\bdynamics\b", r"\bcollision\b",
)

# Symbols by confidence tier, symbols allowed in output, control symbols.
HIGH_GATES = (
    "CNOT", "CX", "CY", "CZ", "CH", "CS", "CT", "CP", "CPHASE", "CRX", "CRY", "CRZ", "CU", "CU1", "CU2", "CU3", "SWAP", "ISWAP", "SQRTSWAP",
    "TOFFOLI", "CCX", "CCNOT", "CCZ", "CSWAP", "FREDKIN", "MCX", "MCZ", "C3X", "C4X", "RXX", "RYY", "RZZ", "RZX", "XX", "YY", "ZZ",
    "DCX", "ECR", "BARRIER", "MEASURE", "RESET", "HADAMARD",
)
MEDIUM_GATES = ("RX", "RY", "RZ", "Rx", "Ry", "Rz", "U", "U1", "U2", "U3", "P", "PHASE", "SX", "SQRTX", "SDG", "TDG", "V", "VDG")
LOW_GATES = ("H", "X", "Y", "Z", "S", "T", "I", "ID", "M")
OUTPUT_GATES = (
    "H", "HADAMARD", "X", "Y", "Z", "S", "T", "CNOT", "CX", "CY", "CZ", "CH", "CS", "CT", "SWAP", "ISWAP", "TOFFOLI", "CCX", "FREDKIN", "CSWAP",
    "RX", "RY", "RZ", "CRX", "CRY", "CRZ", "U", "U1", "U2", "U3", "MEASURE", "M", "RESET", "BARRIER",
)
CONTROL_GATES = ("CNOT", "CX", "CZ", "CY", "CH", "CS", "CT", "TOFFOLI", "CCX", "CCNOT", "CCZ", "CSWAP", "FREDKIN")

# Names of symbols in text and their standard form.
GATE_NAMES = {
    "hadamard": "H", "pauli-x": "X", "pauli-y": "Y", "pauli-z": "Z", "not": "X", "controlled-not": "CNOT", "controlled-x": "CNOT", "cx": "CNOT",
    "toffoli": "CCX", "ccnot": "CCX", "fredkin": "CSWAP",
}
GATE_ALIASES = {"CX": "CNOT", "CONTROLLED-X": "CNOT", "CONTROLLED-NOT": "CNOT", "TOFFOLI": "CCX", "MEASURE": "M", "MEASUREMENT": "M"}
TEXT_GATES = (
    (r"\b(Hadamard)\s+gate", "H"), (r"\b(CNOT|CX|controlled-NOT)\b", "CNOT"), (r"\b(Toffoli|CCX)\b", "CCX"), (r"\b(SWAP)\s+gate", "SWAP"),
    (r"\b(Pauli-X|Pauli X)\b", "X"), (r"\b(Pauli-Y|Pauli Y)\b", "Y"), (r"\b(Pauli-Z|Pauli Z)\b", "Z"),
)

# Algorithm keywords (first hit wins) and fallback patterns.
ALGORITHMS = (
    ("grover", "Grover's Algorithm"), ("shor", "Shor's Algorithm"), ("qft", "Quantum Fourier Transform"), ("fourier", "Quantum Fourier Transform"),
    ("vqe", "VQE"), ("variational quantum eigensolver", "VQE"), ("qaoa", "QAOA"), ("quantum approximate optimization", "QAOA"),
    ("teleportation", "Quantum Teleportation"), ("error correction", "Quantum Error Correction"), ("qec", "Quantum Error Correction"),
    ("bernstein", "Bernstein-Vazirani Algorithm"), ("deutsch", "Deutsch-Jozsa Algorithm"), ("simon", "Simon's Algorithm"),
    ("phase estimation", "Quantum Phase Estimation"), ("qpe", "Quantum Phase Estimation"), ("hhl", "HHL Algorithm"),
)
FALLBACK_PROBLEMS = (
    ("vqe", "VQE"), ("variational quantum eigensolver", "VQE"), ("qaoa", "QAOA"), ("quantum approximate optimization", "QAOA"),
    ("grover", "Grover_Algorithm"), ("quantum search", "Grover_Algorithm"), ("shor", "Shor_Algorithm"), ("factorization", "Shor_Algorithm"),
    ("qft", "QFT_QPE"), ("quantum fourier", "QFT_QPE"), ("phase estimation", "QFT_QPE"),
)

#: topics in order of precedence, with a compact phrase list of our own; callers pass theirs
TOPIC_PHRASES = (
    ("Grover_Algorithm", ("grover", "amplitude amplification", "quantum search")),
    ("Shor_Algorithm", ("shor", "integer factoring", "period finding")),
    ("QFT_QPE", ("quantum fourier", "phase estimation", "qft")),
    ("VQE", ("variational quantum eigensolver", "vqe")),
    ("QAOA", ("qaoa", "approximate optimization")),
    ("Quantum_Simulation", ("hamiltonian simulation", "trotter")),
    ("Quantum_Machine_Learning", ("quantum neural", "quantum kernel")),
    ("Quantum_Cryptography", ("key distribution", "bb84")),
    ("Error_Correction", ("surface code", "stabilizer", "error correction")),
    ("Hardware_Architecture", ("transmon", "trapped ion")),
    ("Benchmarking", ("randomized benchmarking", "quantum volume")),
    ("Optimization_Problems", ("max-cut", "maxcut", "qubo")),
)

# Roman numerals of figure numbers.
ROMAN = {"I": 1, "II": 2, "III": 3, "IV": 4, "V": 5, "VI": 6, "VII": 7, "VIII": 8, "IX": 9, "X": 10}

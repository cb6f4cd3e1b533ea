"""Advice for Bandit's rule ids, in our own words after the public Bandit documentation."""

# --- fixed values: the rule ids that have advice ---------------------------------------------
BANDIT_ADVICE = {
    "B201": "Turn the Flask debugger off outside development.",
    "B301": "Deserialise untrusted input with JSON instead of pickle.",
    "B302": "Do not load marshal data from untrusted sources.",
    "B303": "Replace MD5 and SHA-1 by SHA-256 or stronger.",
    "B304": "Replace the broken cipher by AES-GCM.",
    "B305": "Choose an authenticated cipher mode such as GCM.",
    "B306": "Create temporary files with mkstemp.",
    "B307": "Parse literals with ast.literal_eval, never with eval.",
    "B308": "Escape markup unless its origin is trusted.",
    "B310": "Allow only http and https before opening a URL.",
    "B311": "Draw security tokens from the secrets module.",
    "B312": "Replace Telnet by SSH.",
    "B313": "Parse XML with defusedxml.cElementTree.",
    "B314": "Parse XML with defusedxml.ElementTree.",
    "B315": "Read SAX events with defusedxml.expatreader.",
    "B316": "Build SAX trees with defusedxml.expatbuilder.",
    "B317": "Parse SAX input with defusedxml.sax.",
    "B318": "Parse DOM input with defusedxml.minidom.",
    "B319": "Parse pulled DOM input with defusedxml.pulldom.",
    "B320": "Switch lxml's entity and network access off.",
    "B321": "Replace FTP by SFTP.",
    "B322": "Read console text with raw input handling, not Python 2 input.",
    "B323": "Keep certificate checks of the default SSL context.",
    "B324": "Name a strong hash in hashlib calls.",
    "B401": "Drop telnetlib and connect through SSH.",
    "B402": "Drop ftplib and transfer through SFTP.",
    "B403": "Check that pickled data never comes from outside.",
    "B404": "Check every subprocess call for untrusted arguments.",
    "B405": "Import defusedxml in place of xml.etree.",
    "B406": "Import defusedxml in place of xml.sax.",
    "B407": "Import defusedxml in place of xml.dom.expatbuilder.",
    "B408": "Import defusedxml in place of xml.dom.minidom.",
    "B410": "Import lxml only for trusted documents.",
    "B411": "Patch XML-RPC with defusedxml.xmlrpc.",
    "B412": "Do not serve through wsgiref's CGI handler.",
    "B413": "Replace the abandoned PyCrypto by cryptography.",
    "B501": "Leave TLS certificate verification on.",
    "B502": "Require TLS 1.2 or newer.",
    "B503": "Do not default to an old protocol version.",
    "B504": "Pass the protocol version explicitly.",
    "B505": "Generate RSA keys of 2048 bits or more.",
    "B506": "Load YAML with the safe loader.",
    "B507": "Verify host keys of SSH servers.",
    "B601": "Quote what is passed to remote shells.",
    "B602": "Call subprocess without a shell.",
    "B603": "Pass only checked arguments to subprocess.",
    "B604": "Avoid shell=True in wrapper functions.",
    "B605": "Replace os.system by subprocess with a list.",
    "B606": "Check the program started without a shell.",
    "B607": "Start programs by their full path.",
    "B608": "Bind SQL parameters instead of building text.",
    "B609": "Expand wildcards yourself before calling a command.",
    "B610": "Keep untrusted input out of Django extra().",
    "B611": "Keep untrusted input out of Django RawSQL.",
    "B701": "Turn Jinja2 autoescaping on.",
    "B702": "Apply Mako's default HTML filter.",
    "B703": "Do not mark dynamic text as safe.",
}
# ---------------------------------------------------------------------------------------------

BANDIT_DEFAULT = "Check this code against secure coding guidance."
